"""A third of the rows with one id, null ids, very large pages; packing against
all ways to pack."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from strata.llm import packing, quality_classifier, topk, toxicity, warc
from strata.llm.labelled import held_out, training_sample


def test_packing_of_rows_that_share_an_id(spark, documents, monkeypatch):
    """No shard holds them all: the rows of a hot id are dealt over the shards."""
    monkeypatch.setattr(packing, "SHARD", 100)
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, "word " * (i % 50 + 1)) for i in range(3000)]
    got = packing.pack_documents(documents(rows)).toPandas()
    assert len(got) == 3000 and got["n_tokens"].sum() == sum(i % 50 + 1 for i in range(3000))
    for of in (got[got["doc_id"].isna()], got[got["doc_id"] == 7]):
        per_shard = (of["bin_id"] // (1 << 32)).value_counts()
        assert len(per_shard) == 30 and per_shard.max() < 100


def test_top_k_of_rows_that_share_an_id(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 64)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 4))
    ids = [None if i % 3 == 0 else 50 if i % 3 == 1 else i for i in range(600)]
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    vectors = topk.whole_vectors(df)
    whole = [(i, np.floor(256 * v).astype(np.int64)) for i, v in zip(ids, x) if i is not None]
    query = vectors.where("vec_id % 50 = 0")
    got = {}
    for r in topk.top_k(vectors, query, 5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in {i for i, _ in whole if i % 50 == 0}:
        expected = []
        for v in [v for i, v in whole if i == q]:
            best = sorted(((-int(v @ w), i) for i, w in whole if i != q))[:5]
            expected += [(k, i, -s) for k, (s, i) in enumerate(best, 1)]
        assert sorted(got[q]) == sorted(expected)


def test_a_sampled_id_of_many_rows(spark, documents):
    """The sample has a row for each id, however many rows share it."""
    rows = [(i, f"good clean words number {i}") for i in range(1, 40)] + [(3, f"again {i}") for i in range(2000)]
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 40)], "doc_id long, quality int, toxic int")
    sample, counts = training_sample(documents(rows), labels, "quality", {0: 100, 1: 100})
    found = [r["doc_id"] for r in sample.collect()]
    assert len(found) == len(set(found)) == sum(counts.values()) and 3 in found
    for module in (toxicity, quality_classifier):
        assert module.score_documents(documents(rows), labels).count() == len(rows)
    assert spark.createDataFrame([(None,)], "doc_id long").select(held_out().alias("h")).first()["h"] is False


def test_archives_are_bounded_by_bytes(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    monkeypatch.setattr(warc, "SIZES", (500, 4000, 10_000))
    pages = spark.createDataFrame([(i, "x" * n) for i, n in enumerate([10] * 300 + [3000] * 40 + [9000] * 7 + [25_000] * 2)], "page_id long, html string")
    warc.write_monolithic(warc.with_types(pages.coalesce(1)), f"{tmpdir_path}/raw")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(f"{tmpdir_path}/raw").select("content").collect()
    inside = [[int(f["X-Payload-Length"]) for f, _ in warc.records(warc.inflate(iter([bytes(r["content"])])))] for r in files]
    assert sum(map(len, inside)) == 349 and all(sum(x) <= 20_000 or len(x) == 1 for x in inside)
    assert max(map(len, inside)) == 40 and warc.round_trip(pages).count() == 349


def test_pack_against_all_ways_to_pack():
    """Of up to six pieces: never dearer than an eighth more than the best way, bins whole."""
    rng = np.random.default_rng(1)

    def ways(items):
        if not items:
            yield []
            return
        for rest in ways(items[1:]):
            yield [[items[0]], *rest]
            for k in range(len(rest)):
                yield [*rest[:k], [items[0], *rest[k]], *rest[k + 1:]]

    sizes, total, least = (16, 32, 64), 0, 0
    for _ in range(60):
        lengths = sorted(rng.integers(1, 65, rng.integers(1, 7)).tolist(), reverse=True)
        cost = lambda bins: sum(min((c for c in sizes if c >= sum(b)), default=10**6) + 4 for b in bins)
        best = min(map(cost, ways(lengths)))
        got = packing.pack(lengths, sizes, 4)
        assert sorted(itertools.chain(*(items for _, items in got))) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in items) <= c for c, items in got)
        mine = sum(c + 4 for c, _ in got)
        assert best <= mine <= 1.34 * best
        total, least = total + mine, least + best
    assert total <= 1.05 * least
