"""Splits and folds of exact size: row_number over the hash, any layout."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from strata.operators import split
from strata.operators.split import exact_folds, exact_split


def rank(rows, seed, of=lambda r: 0):
    """(rank, size) of each row in its class by hash and key."""
    out = {}
    for c in {of(r) for r in rows}:
        own = sorted((r for r in rows if of(r) == c), key=lambda r: (hashlib.md5(f"{seed}:{r[0]}".encode()).hexdigest()[:12], r[0]))
        out.update({r: (i, len(own)) for i, r in enumerate(own)})
    return out


def fold_of(i, n, k):
    return max(f for f in range(k) if f * n // k <= i)


@pytest.mark.parametrize("n", [1, 4, 5, 891, 3000])
def test_sizes_and_members(spark, n):
    rows = [(i * 7 + 3, int(i % 3 == 0)) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, y int")
    for stratify, of in ((None, lambda r: 0), ("y", lambda r: r[1])):
        ranks = rank(rows, "42f", of)
        got = {(r["id"], r["y"]): r["fold"] for r in exact_folds(df, "id", 5, stratify=stratify).collect()}
        assert got == {r: fold_of(i, m, 5) for r, (i, m) in ranks.items()}
        ranks = rank(rows, 42, of)
        got = {(r["id"], r["y"]): r["is_train"] for r in exact_split(df, "id", stratify=stratify).collect()}
        assert got == {r: i < m - math.ceil(round(m * 0.2, 9)) for r, (i, m) in ranks.items()}
    if n == 891:
        assert exact_split(df, "id").where("is_train").count() == 712


def test_any_layout(spark):
    df = spark.range(2000).withColumn("y", F.col("id") % 2)
    one = exact_folds(df.repartition(1), "id", 4, stratify="y").orderBy("id").collect()
    assert one == exact_folds(df.orderBy(F.desc("id")).repartition(16), "id", 4, stratify="y").orderBy("id").collect()


def test_equal_hashes_go_by_key(spark, monkeypatch):
    """All rows share the hash's prefixes, some whole hashes: the last pass decides by key."""
    monkeypatch.setattr(split, "hash_unit_hex", lambda seed, key, width: F.concat(F.lit("0123456789a"), (key % 2).cast("string")))
    rows = exact_folds(spark.range(50), "id", 5).collect()
    order = sorted(range(50), key=lambda i: (i % 2, i))
    assert {r["id"]: r["fold"] for r in rows} == {i: k * 5 // 50 for k, i in enumerate(order)}


def test_repeated_and_null_keys_and_ends(spark):
    df = spark.createDataFrame([(None, 1)] * 3 + [(1, None)] * 4 + [(i, 1) for i in range(2, 40)] + [(5, 0)] * 100, "id long, y int")
    rows = exact_folds(df, "id", 3, stratify="y").collect()
    assert len(rows) == df.count() and all(r["fold"] == 0 for r in rows if r["id"] is None)
    assert len({r["fold"] for r in rows if r["id"] == 5 and r["y"] == 0}) == 1  # they share a key
    assert exact_split(df, "id", 1.0).where("NOT is_train").count() == 3 and exact_split(df, "id", 0.0).where("is_train").count() == 0
    assert exact_folds(df.limit(0), "id").collect() == []
    with pytest.raises(ValueError):
        exact_folds(df, "id", 1)
    text = spark.createDataFrame([(f"k{i}",) for i in range(20)], "id string")
    assert sorted(r["n"] for r in exact_folds(text, "id", 5).groupBy("fold").agg(F.count("*").alias("n")).collect()) == [4] * 5
