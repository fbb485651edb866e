
from strata.operators.split import fold_column, hex_threshold, split_train_test, train_flag


def test_split_disjoint_complete_and_layout_free(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    tr, te = split_train_test(df, "k")
    n_tr, n_te = tr.count(), te.count()
    assert n_tr + n_te == 20000
    assert tr.join(te, "k").count() == 0
    assert 0.78 < n_tr / 20000 < 0.82
    a = sorted(r.k for r in df.repartition(1).where(train_flag("k")).collect())
    b = sorted(r.k for r in df.repartition(9).where(train_flag("k")).collect())
    assert a == b


def test_folds_partition_rows(spark):
    df = spark.range(10000).withColumnRenamed("id", "k").withColumn("fold", fold_column("k", 5))
    counts = {r.fold: r["count"] for r in df.groupBy("fold").count().collect()}
    assert set(counts) == {0, 1, 2, 3, 4}
    assert sum(counts.values()) == 10000
    assert all(1800 < c < 2200 for c in counts.values())


def test_hex_threshold():
    assert hex_threshold(0.8) == "c" * 12
    assert hex_threshold(0.0) == "0" * 12
    assert all(h < hex_threshold(1.0) for h in ("0" * 12, "f" * 12))


def test_whole_and_empty_fractions(spark):
    df = spark.range(400_000).withColumnRenamed("id", "k")
    for fraction, n in ((1.0, 400_000), (0.0, 0)):
        train, test = split_train_test(df, "k", train_fraction=fraction)
        assert (train.count(), test.count()) == (n, 400_000 - n)


def test_split_and_folds_match_python_md5(spark):
    import hashlib

    from strata.operators.split import FOLD_SEED, SPLIT_SEED
    df = spark.range(3000).withColumnRenamed("id", "k")
    rows = df.select("k", train_flag("k").alias("t"), fold_column("k", 5).alias("f")).collect()
    for r in rows:
        h = hashlib.md5(f"{SPLIT_SEED}:{r.k}".encode()).hexdigest()[:12]
        assert r.t == (h < "c" * 12)
        u = int(hashlib.md5(f"{FOLD_SEED}:{r.k}".encode()).hexdigest()[:12], 16)
        expected = next(i for i in range(5) if i == 4 or u < int((i + 1) / 5 * 16**12))
        assert r.f == expected
