"""Key-hashed train/test split, folds and replicate draws.

A row's side of the split depends only on md5(seed ':' key): no shuffle, the
same on any partition layout, the same after an executor is lost and its
tasks re-run (``randomSplit`` depends on partition order and is neither),
and checkable in any SQL engine with md5.  Thresholds compare fixed-width
lowercase hex prefixes (48 bits), which order like the numbers they spell.

``exact_split`` and ``exact_folds`` give exact sizes, in each class if wanted:
the row at which a part begins is found by counting hash prefixes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import hash_unit_hex

SPLIT_SEED = 42
FOLD_SEED = "42f"
HEX_WIDTH = 12


def hex_threshold(fraction: float, width: int = HEX_WIDTH) -> str:
    """Hex prefix below which a uniform draw falls with ``fraction`` chance.
    0 is the least prefix, which none falls below; 1 is a text that sorts
    after every prefix."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    return "g" if fraction == 1.0 else format(int(fraction * 16 ** width), f"0{width}x")


def train_flag(key: str, seed=SPLIT_SEED, train_fraction: float = 0.8) -> Column:
    return hash_unit_hex(seed, F.col(key), HEX_WIDTH) < F.lit(hex_threshold(train_fraction))


def split_train_test(df: DataFrame, key: str, seed=SPLIT_SEED,
                     train_fraction: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Unstratified split; about ``train_fraction`` of the keys go to train."""
    flag = train_flag(key, seed, train_fraction)
    return df.where(flag), df.where(~flag)


def fold_column(key: str, k: int = 5, seed=FOLD_SEED) -> Column:
    """Fold number 0..k-1 from the key hash (equal-width hex ranges)."""
    h = hash_unit_hex(seed, F.col(key), HEX_WIDTH)
    expr = None
    for i in range(1, k):
        cond = h < F.lit(hex_threshold(i / k))
        expr = F.when(cond, F.lit(i - 1)) if expr is None else expr.when(cond, F.lit(i - 1))
    return (expr.otherwise(F.lit(k - 1)) if expr is not None else F.lit(0)).cast("int")


def fold_sql(key: str, k: int = 5, seed=FOLD_SEED) -> str:
    """The same fold assignment as SQL text."""
    h = f"substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, {HEX_WIDTH})"
    whens = " ".join(f"WHEN {h} < '{hex_threshold(i / k)}' THEN {i - 1}" for i in range(1, k))
    return f"CAST(CASE {whens} ELSE {k - 1} END AS INTEGER)"


def check_folds(df: DataFrame, fold: str, label: str) -> None:
    """Raise unless every fold holds both classes (a count per fold)."""
    classes = {r[fold]: r["n"] for r in df.groupBy(fold).agg(F.count_distinct(label).alias("n")).collect()}
    single = sorted(f for f, n in classes.items() if n < 2)
    if single:
        raise ValueError(f"folds with one class only: {single}")


# ------------------------------------------------------ exact sizes

DIGITS = 4  # hex digits of the hash that a counting pass resolves


def _cuts(rows: DataFrame, ranks: dict) -> dict:
    """For each class the (hash, key) of the rows at the given ranks (from 0)
    of its order by hash and key: the first row that is not below a cut.

    No sort: a pass counts rows by class and the next ``DIGITS`` digits of the
    hash, and only where a rank lies, so the driver sees at most 16^DIGITS
    counts for each; what is left is the rows that share a whole hash, counted
    by key."""
    at = {(c, r): ("", r) for c, rs in ranks.items() for r in rs}  # prefix and rank among the rows that begin with it
    for upto in [*range(DIGITS, HEX_WIDTH + 1, DIGITS), None]:
        wanted = {(c, p) for (c, _), (p, _) in at.items()}
        if not wanted:
            return {}
        length = (upto or HEX_WIDTH + DIGITS) - DIGITS
        spark = rows.sparkSession
        open_ = spark.createDataFrame(sorted(wanted, key=str), f"_c {dict(rows.dtypes)['_class']}, _p string")  # at most one for each cut
        under = rows.join(F.broadcast(open_), F.col("_class").eqNullSafe(F.col("_c")) & (F.substring("_hash", 1, length) == F.col("_p")))
        part = F.col("_key") if upto is None else F.substring("_hash", 1, upto)
        found: dict = {}
        for r in under.groupBy("_class", "_p", part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).collect():
            found.setdefault((r["_class"], r["_p"]), []).append((r["_part"], r["n"]))
        for cut, (prefix, rank) in at.items():
            for piece, n in sorted(found[cut[0], prefix]):
                if rank < n:
                    at[cut] = (prefix, piece) if upto is None else (piece, rank)
                    break
                rank -= n
    return at


def _keyed(df: DataFrame, key: str, seed, stratify: str | None) -> DataFrame:
    held = F.col(stratify) if stratify else F.lit(0)
    return df.select(held.alias("_class"), F.col(key).alias("_key"), hash_unit_hex(seed, F.col(key), HEX_WIDTH).alias("_hash"))


def _parts(df: DataFrame, key: str, seed, stratify: str | None, bounds) -> Column:
    """Which part a row is in, from 0: ``bounds(n)`` gives the ranks, in the
    order of its class by hash and key, at which the parts from 1 on begin."""
    rows = _keyed(df, key, seed, stratify)
    sizes = {r["_class"]: r["n"] for r in rows.groupBy("_class").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each class
    ranks = {c: sorted({b for b in bounds(n) if b < n}) for c, n in sizes.items()}
    cuts = _cuts(rows, ranks)
    h, k = hash_unit_hex(seed, F.col(key), HEX_WIDTH), F.col(key)
    out = F.lit(0)
    for c, rs in ranks.items():
        mine = F.col(stratify).eqNullSafe(F.lit(c)) if stratify else F.lit(True)
        part = F.lit(0)
        for r in rs:
            prefix, first = cuts[c, r]
            reached = (h > F.lit(prefix)) | ((h == F.lit(prefix)) & (k >= F.lit(first)))
            part = part + bounds(sizes[c]).count(r) * reached.cast("int")
        out = F.when(mine, part).otherwise(out)
    return out.cast("int")


def exact_folds(df: DataFrame, key: str, k: int = 5, seed=FOLD_SEED, stratify: str | None = None, out: str = "fold") -> DataFrame:
    """``df`` with a fold 0..k-1 whose sizes differ by one row at most, in each
    class of ``stratify`` if given.  Fold i holds the ranks from floor(i n / k)
    to floor((i + 1) n / k) of the class by hash and key: it depends on the keys
    alone, not on the layout.  Rows that share a key share a fold, and a null
    key has no hash: its rows are in fold 0."""
    if k < 2:
        raise ValueError("at least two folds")
    part = _parts(df.where(F.col(key).isNotNull()), key, seed, stratify, lambda n: [i * n // k for i in range(1, k)])
    return df.withColumn(out, F.when(F.col(key).isNull(), F.lit(0)).otherwise(part))


def exact_split(df: DataFrame, key: str, train_fraction: float = 0.8, seed=SPLIT_SEED, stratify: str | None = None, out: str = "is_train") -> DataFrame:
    """``df`` with a flag that is true on exactly n - ceil(n (1 - fraction)) of
    n rows (712 of 891 at 0.8), of each class of ``stratify`` if given: those
    first by hash and key.  Rows with a null key are not in train."""
    if not 0.0 <= train_fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    train = lambda n: [n - math.ceil(round(n * (1 - train_fraction), 9))]
    part = _parts(df.where(F.col(key).isNotNull()), key, seed, stratify, train)
    return df.withColumn(out, F.when(F.col(key).isNull(), F.lit(False)).otherwise(part == 0))
