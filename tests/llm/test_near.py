"""Line dedup and Jaccard join against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from strata.llm import jaccard_join, line_dedup
from strata.llm.store import Scratch, components


def roots(nodes, linked):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for x, y in linked:
        a, b = sorted((find(x), find(y)))
        parent[b] = a
    return find


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)] + [(500, 500 + i) for i in range(1, 50)] + [(7, 7)]
    find = roots(range(600), edges)
    with Scratch() as scratch:
        got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), scratch).collect()}
        assert got == {x: find(x) for x in {x for a, b in edges if a != b for x in (a, b)}}
        assert components(spark.createDataFrame([], "a long, b long"), scratch).collect() == []


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def within(a, b, edits):
    """Whether the edit distance is ``edits`` at most, by the diagonals that far from the main one."""
    far = edits + 1
    row = {j: j for j in range(edits + 1)}
    for i, x in enumerate(a, 1):
        new = {}
        for j in range(max(0, i - edits), min(len(b), i + edits) + 1):
            new[j] = min(row.get(j, far) + 1, new.get(j - 1, far) + 1, row.get(j - 1, far) + (x != b[j - 1]) if j else far)
        row = new
    return row.get(len(b), far) <= edits


def test_within():
    rng = random.Random(4)
    for _ in range(2000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(12)))
        b = edited(rng, a, rng.randrange(4)) if a else "a"
        assert all(within(a, b, e) == (levenshtein(a, b) <= e) for e in range(5))


def edited(rng, s, times):
    s = list(s)
    for _ in range(times):
        what, i = rng.randrange(3), rng.randrange(len(s))
        if what == 0:
            s[i] = rng.choice("abé")
        elif what == 1:
            s.insert(i, rng.choice("abé"))
        elif len(s) > 1:
            del s[i]
    return "".join(s)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(spark, edits):
    rng = random.Random(2)
    pairs = []
    for _ in range(500):
        a = "".join(rng.choice("abcé") for _ in range(rng.randint(5, 30)))
        pairs.append((a, edited(rng, a, rng.randint(0, 5))))
    df = (spark.createDataFrame([p for p in pairs if min(map(len, p)) > edits], "a string, b string").where(F.abs(F.length("a") - F.length("b")) <= edits)
          .select("a", "b", F.split("a", "").alias("ca"), F.split("b", "").alias("cb")))
    for r in df.select("a", "b", line_dedup.banded_distance("ca", "cb", edits).alias("d")).collect():
        true = levenshtein(r["a"], r["b"])
        assert r["d"] == true if true <= edits else r["d"] > edits


def brute_lines(docs, edits, least):
    is_line = lambda x: x.strip(" ") != ""
    lines = sorted({x for _, t in docs for x in (t or "").split("\n") if is_line(x)})
    permitted = lambda n: max((e for lo, e in (((least, edits),) if isinstance(edits, int) else edits) if n >= lo), default=-1)
    find = roots(lines, [(a, b) for i, a in enumerate(lines) for b in lines[i + 1:]
                         if abs(len(a) - len(b)) <= (e := permitted(min(len(a), len(b)))) and within(a, b, e)])
    key = lambda i: (i is None, i or 0)
    first = {}
    for i, t in docs:
        for x in (t or "").split("\n"):
            if is_line(x):
                first[find(x)] = min(first.get(find(x), (True, 1 << 60)), key(i))
    out = []
    for i, t in docs:
        seen, kept = set(), []
        for x in (t or "").split("\n"):
            if not is_line(x):
                kept.append(x)
                continue
            if first[find(x)] in (key(i), (True, 1 << 60)) and find(x) not in seen:
                kept.append(x)
            seen.add(find(x))
        out.append((i, None if t is None else "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("edits,hot", [(1, 16), (2, 16), (((20, 1), (40, 2), (90, 4)), 16), (((10, 1), (21, 3)), 1)])
def test_lines_against_brute_force(documents, edits, hot, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT", hot)
    rng = random.Random(3)
    base = ["".join(rng.choice("abc dé") for _ in range(rng.choice([1, 5, 19, 20, 21, 22, 40, 90]))) for _ in range(20)]
    if hot == 1:  # all keys are split down to the last characters: fewer and shorter lines
        base = [x[:30] for x in base[:8]]
    docs = [(100, None), (101, ""), (102, "\n \n"), (103, "x\nx\nx"), (104, "y" * 30_000 + "\n" + "y" * 29_999 + "z")]
    docs += [(i, "\n".join(edited(rng, rng.choice(base), rng.choice([0, 0, 1, 1, 2, 3])) for _ in range(rng.randint(1, 6)))) for i in range(40)]
    docs += [docs[-1], (200, docs[-2][1]), (None, base[0] + "\nonly here, in the row without an id")]
    rng.shuffle(docs)
    frame = documents(docs)
    out = line_dedup.dedup_lines(frame, edits)
    assert out.columns == frame.columns
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == brute_lines(docs, edits, line_dedup.MIN_CHARS)
    if edits != 1 or hot == 1:
        return
    for r in line_dedup.dedup_report(frame, edits).collect():
        assert r["n_dropped"] == len(r["dropped_lines"]) <= r["n_lines"]


def test_lines_of_an_empty_table(documents):
    assert line_dedup.dedup_lines(documents([])).collect() == [] == line_dedup.dedup_report(documents([])).collect()


@pytest.mark.parametrize("edits", [1, 3])
def test_short_rests_below_hot_keys(documents, monkeypatch, edits):
    """All keys are hot, down to the last characters, which differ, move and
    are put in or left out."""
    monkeypatch.setattr(line_dedup, "HOT", 0)
    rng = random.Random(edits)
    base = "abcdefghijkl"
    lines = {base[:i] + c + base[i + k:] for i in range(0, 12, 2) for c in ("x", "yx", "", "語", "xa") for k in (0, 1, 2)} | {"".join(rng.choice("ab") for _ in range(rng.randint(8, 12))) for _ in range(25)}
    docs = [(i, x) for i, x in enumerate(sorted(lines))]
    out = line_dedup.dedup_lines(documents(docs), ((5, edits),))
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == brute_lines(docs, ((5, edits),), 5)


def test_bands_are_checked():
    for bad in (((20, 1), (21, 2)), ((20, 2), (40, 1)), ((2, 3),)):
        with pytest.raises(ValueError):
            line_dedup.checked_bands(bad, 20)
    assert line_dedup.checked_bands(2, 20) == ((20, 2),)


def test_lines_of_one_template(documents, monkeypatch):
    """Thousands of lines that differ in eight digits, or count up: pairs in
    proportion to the lines, not to their square; the links are those of brute force."""
    rng, n = random.Random(7), 5000
    seen, stored = [], Scratch.stored

    def counted(self, df, name):
        out = stored(self, df, name)
        if name in ("pairs", "hot_pairs"):
            seen.append(out.count())
        return out

    monkeypatch.setattr(Scratch, "stored", counted)
    for numbers in ([f"{rng.randrange(10**8):08d}" for _ in range(n)], [f"{i:08d}" for i in range(n)]):
        seen.clear()
        lines = [f"2024-01-01 INFO user {x} logged in from home" for x in sorted(set(numbers))]
        kept = line_dedup.dedup_lines(documents([(i, x) for i, x in enumerate(lines)])).where("text <> ''").count()
        assert max(seen) < 40 * n
        places = {}  # of equal length: within one edit if all but one digit agree
        for x in set(numbers):
            for k in range(8):
                places.setdefault((k, x[:k] + x[k + 1:]), []).append(x)
        find = roots(set(numbers), [(g[0], y) for g in places.values() for y in g[1:]])
        assert kept == len({find(x) for x in set(numbers)})


def test_line_dedup_runs_no_python(documents):
    plan = line_dedup.dedup_lines(documents([(1, "a\na")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def brute_components(rows, low=90, high=100):
    sets = {}
    for i, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets[i] = {tuple(w[k:k + 3]) for k in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()
    ids = sorted(sets)
    find = roots(ids, [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:]
                       if sets[a] and sets[b] and high * len(sets[a] & sets[b]) >= low * len(sets[a] | sets[b])])
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(rng, groups):
    words, rows = [f"w{i}" for i in range(400)], []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([4, 8, 12, 14, 30, 60, 200, 600]))]
        for _ in range(rng.choice([1, 3, 10])):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 40))):
                k = rng.randrange(len(w))
                w[k] = rng.choice(words) if rng.random() < 0.7 else w[k].upper()
            rows.append((len(rows), " ".join(w[:-rng.randint(1, 3)] if rng.random() < 0.3 else w)))
    return rows


def test_jaccard_join_against_brute_force(documents):
    rng = random.Random(5)
    rows = near_copies(rng, 14) + [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "A b"), (1004, "a\vB"), (1005, "word " * 30_000), (1006, "É x"), (1007, "é x")]
    base = [rng.choice("abcdefgh") + str(rng.randrange(300)) for _ in range(150)]  # a group whose copies link by chance
    for i in range(60):
        w = list(base)
        for _ in range(3):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        rows.append((2000 + i, " ".join(w)))
    rng.shuffle(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join_documents(documents(rows)).collect()}
    assert got == brute_components(rows)
    kept = jaccard_join.keep_first(documents(rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in got.values()})


def test_jaccard_cases(documents):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "A B c d"), (None, "a b c d"), (None, "q r s t"), (None, None)]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.join_documents(documents(rows)).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (2, 2, 1), (None, 2, 1), (None, 2, None), (None, 0, None)], key=str)
    kept = jaccard_join.keep_first(documents(rows))
    assert kept.columns == documents(rows).columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, None, None, None]
    assert jaccard_join.join_documents(documents([])).collect() == [] == jaccard_join.keep_first(documents([])).collect()


def test_segments_find_every_link():
    rng = random.Random(8)
    import numpy as np
    for _ in range(400):
        n = rng.choice([9, 10, 11, 19, 20, 57, 190, 400])
        a = np.array(rng.sample(range(1 << 62), n), np.uint64)
        b = a[rng.randint(0, n // 9):]
        while 100 * len(np.intersect1d(a, b)) < 90 * len(np.union1d(a, b)):
            b = a[n - len(b) - 1:]
        extra = 0
        while 100 * len(np.intersect1d(a, b)) >= 90 * len(np.union1d(a, b)) and extra < 5:
            x, y = jaccard_join.segment_keys(np.unique(a)), jaccard_join.segment_keys(np.unique(b))
            assert len(a) == len(b) == len(np.intersect1d(a, b)) or len(np.intersect1d(x, y))
            b, extra = np.append(b, np.uint64(rng.randrange(1 << 62))), extra + 1
        d = bin(int("".join(f"{int(v):064b}" for v in jaccard_join.folded(a) ^ jaccard_join.folded(b)), 2)).count("1")
        assert d <= len(np.setxor1d(a, b))
