"""WARC round trips, exact top-k and packing against brute force."""

import gzip
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import packing, topk, warc


def test_inflate_and_records_in_any_pieces():
    rng = random.Random(1)
    blocks = [bytes(rng.randrange(256) for _ in range(rng.randint(0, 3000))) for _ in range(20)]
    blocks.append(b"\r\n\r\nWARC/1.1\r\n" * 300)
    whole = [b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n" % len(b) + b + b"\r\n\r\n" for b in blocks]
    for stream in (gzip.compress(b"".join(whole)), b"".join(map(gzip.compress, whole))):  # one member, many members
        for step in (1, 7, 1000, 1 << 20):
            chunks = (stream[i:i + step] for i in range(0, len(stream), step))
            assert [r for _, r in warc.records(warc.inflate(chunks))] == whole
    with pytest.raises(ValueError):
        list(warc.records(warc.inflate(iter([gzip.compress(b"".join(whole))[:-20]]))))
    assert list(warc.records(warc.inflate(iter([])))) == []


BIG = "é" * 600
PAGES = [(1, BIG), (2, BIG), (5, BIG), (3, ""), (4, None), (6, ""), (7, "a" * 999), (8, "a" * 999), (None, BIG), (9, "b\r\n\r\nWARC/1.1\r\n" * 100),
         (9, "b\r\n\r\nWARC/1.1\r\n" * 100), (10, "c" * 1000), (11, "x" * 3_000_000)]


def expected(rows):
    out = []
    for page, html in rows:
        data = (html or "").encode()
        same = [p for p, h in rows if (h or "").encode() == data and p is not None]
        first = max(same) if len(data) >= 1000 and same else None
        revisit = first is not None and page != first
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    kind = "page_id long, html string, url string, same string, first string"
    pages = spark.createDataFrame([(*p, "u", "s", "f") for p in PAGES], kind)
    assert sorted((tuple(r) for r in warc.round_trip(pages).collect()), key=str) == expected(PAGES)
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_archives_are_gzip_with_an_index(spark, tmpdir_path):
    pages = spark.createDataFrame(PAGES, "page_id long, html string").repartition(2)
    raw, clean = f"file://{tmpdir_path}/raw", f"file://{tmpdir_path}/clean"
    warc.write_monolithic(warc.with_types(pages), raw)
    done = warc.normalise(spark, raw, clean).collect()
    assert sum(r["records"] for r in done) == len(PAGES)
    for r in done:
        path = r["archive"].removeprefix("file://")
        data, plain = open(path, "rb").read(), gzip.open(path).read()
        assert len(data) == r["bytes"] and plain.count(b"WARC-Record-ID") == r["records"]
    assert len(warc.read_archives(spark, clean).collect()) == len(PAGES)


def brute_top(rows, queries, k):
    out = []
    for q, v in queries:
        found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q and len(w) == len(v))[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(found, 1)]
    return sorted(out)


def test_top_k_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 150)  # several shards and blocks
    monkeypatch.setattr(topk, "BLOCK", 20)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(800)]
    rows += [(1000 + i, rows[50][1]) for i in range(300)]  # one very common vector: ties
    rows += [(2000, None), (2050, [1.0, None] + [0.0] * 6), (2100, [float("nan")] * 8), (2150, [float("inf")] * 8), (None, [1.0] * 8),
             (2200, [1.0, 2.0]), (2201, [3.0, 1.0]), (2250, []), (2251, []), (1, rows[1][1])]
    table = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, v string, dim string")
    vectors = topk.whole_vectors(table)
    got = sorted(tuple(r) for r in topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5).collect())
    whole = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    assert got == brute_top(whole, [(i, v) for i, v in whole if i % 50 == 0], 5)
    none = topk.whole_vectors(table.limit(0))
    assert topk.top_k(none, none, 5).collect() == []
    few = vectors.where("vec_id in (50, 51, 52)")
    assert topk.top_k(few, few.where("vec_id = 50"), 5).count() == 2  # all, if fewer


def test_ball_tree_prunes_and_is_exact():
    rng = np.random.default_rng(0)
    centres = rng.integers(-400, 400, (40, 16))
    points = np.concatenate([c + rng.integers(-5, 5, (100, 16)) for c in centres])
    ids = rng.permutation(len(points))
    tree = topk.BallTree(ids, points)
    for q in points[::97]:
        score = points @ q
        want = [(int(score[j]), int(ids[j])) for j in np.lexsort((ids, -score))[:5]]
        assert tree.search(q, -1, 5, None) == want == tree.search(q, -1, 5, want[-1][0])
    with pytest.raises(OverflowError):
        topk.BallTree(np.arange(2), np.full((2, 3), 1 << 40)).search(np.full(3, 1 << 40), -1, 1, None)


def test_pack_wastes_no_more_than_one_size():
    rng = random.Random(3)
    for sizes in ((8, 16, 32), (10,), (5, 7, 64)):
        for _ in range(60):
            lengths = sorted((rng.randint(1, max(sizes)) for _ in range(rng.randint(1, 60))), reverse=True)
            bins = packing.pack(lengths, sizes, overhead=2)
            assert sorted(i for _, items in bins for i in items) == list(range(len(lengths)))
            for capacity, items in bins:
                fill = sum(lengths[i] for i in items)
                assert fill <= capacity and capacity == min(c for c in sizes if c >= fill)  # downsized
            cost = sum(c + 2 for c, _ in bins)
            for size in sizes:
                plain = packing._best_fit(lengths, sizes, lambda i, s=size: max(s, min(c for c in sizes if c >= lengths[i])))
                assert cost <= sum(c + 2 for c, _ in plain)
            assert cost >= sum(lengths)


def test_packed_documents_are_whole(spark, documents, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 40)
    rng = random.Random(5)
    texts = [None, "", " \n", "one", "w " * 50_000, *("w " * rng.randint(1, 3000) for _ in range(120))]
    rows = [*enumerate(texts), (5, texts[5]), (None, "two words")]
    got = packing.pack_documents(documents(rows)).collect()
    want = sum(len((t or "").split()) for _, t in rows)
    assert sum(r["n_tokens"] for r in got) == want
    assert {r["doc_id"] for r in got} == {i for i, _ in rows}
    assert all((r["bin_id"] is None) == (r["n_tokens"] == 0) for r in got)
    bins, pieces = {}, {}
    for r in got:
        if r["n_tokens"]:
            bins.setdefault((r["bin_id"], r["bin_capacity"]), []).append((r["bin_start"], r["n_tokens"]))
            pieces.setdefault(r["doc_id"], []).append((r["start"], r["n_tokens"]))
    assert len({b for b, _ in bins}) == len(bins)
    for (_, capacity), items in bins.items():
        end = 0
        for start, n in sorted(items):
            assert start == end
            end += n
        assert end <= capacity and capacity in packing.CAPACITIES
    assert sorted(pieces[4]) == [(s, min(8192, 50_000 - s)) for s in range(0, 50_000, 8192)]
    assert packing.pack_documents(documents([])).collect() == []
    # any length column
    assert packing.pack_documents(documents([(1, "abc")]), F.length("text").cast("long")).collect()[0]["n_tokens"] == 3
