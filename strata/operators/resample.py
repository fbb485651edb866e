"""Exact resampling with replacement, distributed.

A bootstrap replicate draws n of n rows with replacement: the rows' weights
are multinomial and add up to n.  No row index is needed to draw them.  Equal
rows are counted first (they are one row with a multiplicity, so a row that
fills a third of the table is one row here).  Rows lie on a line by the hash
of their values; the line is cut into ranges of about ``LEAF`` rows, and the
ranges form a tree of ``FAN`` children a node.  From the root down, a node's
draws of each replicate are split over its children by a multinomial whose
chances are the children's shares of rows, seeded by the node.  A leaf splits
its draws over its own rows in the same way whenever they are asked for.

So every replicate adds up to n, and weights depend on the rows and the seed
alone (not on partitions, order or lost tasks).  What is stored beside the rows
is a number for each leaf and replicate; who reads the weights more than once
stores them too, compressed to some 0.3 bytes a row and replicate
(``weighted_blocks``): splitting a leaf's draws takes longer than most uses.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF = 2048  # distinct rows of a leaf, about
FAN_BITS = 8  # a node has 2^8 children

BLOCKS = "leaf long, n_rows int, y array<double>, x array<double>, m array<long>"
WEIGHTED = f"{BLOCKS}, w binary, w_bytes int"


def leaf_bits(distinct_rows: int, leaf: int = LEAF) -> int:
    """Bits of the hash that name a leaf."""
    return max(0, (max(1, distinct_rows) - 1).bit_length() - (leaf.bit_length() - 1))


def row_blocks(df: DataFrame, label: str, features: Sequence[str], leaf: int = LEAF) -> tuple[DataFrame, int]:
    """(BLOCKS, bits): the distinct rows of each leaf in a fixed order, ``x``
    row after row, ``m`` how often each stands in ``df``.  They are stored in the
    shared checkpoint folder; the distinct rows are found once."""
    from strata.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    cols = [F.col(label).cast("double").alias("_y"), *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)]]
    names = ["_y", *[f"_x{i}" for i in range(len(features))]]
    distinct = df.select(*cols).groupBy(*names).agg(F.count(F.lit(1)).alias("_m")).persist(StorageLevel.MEMORY_AND_DISK)
    bits = leaf_bits(distinct.count(), leaf)
    line = F.shiftrightunsigned(F.xxhash64(*names), 64 - bits) if bits else F.lit(0).cast("long")

    def block(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in names])
        x = np.column_stack([table[c].to_numpy() for c in names[1:]]) if features else np.zeros((table.num_rows, 0))
        one = lambda v, kind: pa.array([v], pa.list_(kind))
        return pa.table([pa.array([table["leaf"][0].as_py()], pa.int64()), pa.array([table.num_rows], pa.int32()), one(table["_y"].to_numpy(), pa.float64()),
                         one(x.ravel(), pa.float64()), one(table["_m"].to_numpy(), pa.int64())], names=[f.split()[0] for f in BLOCKS.split(", ")])

    blocks = distinct.select(line.alias("leaf"), *names, "_m").groupBy("leaf").applyInArrow(block, BLOCKS).checkpoint()
    distinct.unpersist()
    return blocks, bits


def leaf_draws(blocks: DataFrame, bits: int, replicates: int, seed: int, draws: int | None = None) -> DataFrame:
    """(leaf, draws array<long>): how many of each replicate's draws fall to
    each leaf of ``blocks``.  ``draws``: of a replicate, as many as rows if not said."""
    spark = blocks.sparkSession
    sizes = blocks.select(F.col("leaf").alias("node"), F.aggregate("m", F.lit(0).cast("long"), lambda a, m: a + m).alias("size")).checkpoint()  # a number a leaf: each level reads these, not the rows
    n = int(sizes.agg(F.sum("size")).first()[0] or 0)
    node = spark.createDataFrame([(0, [n if draws is None else draws] * replicates)], "node long, draws array<long>")
    upto = 0
    while upto < bits:
        level, upto = upto, min(bits, upto + FAN_BITS)
        step = upto - level
        children = sizes.groupBy(F.shiftright("node", bits - upto).alias("child")).agg(F.sum("size").alias("size"))
        # at most 2^FAN_BITS children of a node
        grouped = children.groupBy(F.shiftright("child", step).alias("of")).agg(F.sort_array(F.collect_list(F.struct("child", "size"))).alias("kids"))

        def split(frames: Iterator[pd.DataFrame], level=level) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for of, mine, kids in zip(frame["of"], frame["draws"], frame["kids"]):
                    rng = np.random.default_rng([seed, level, int(of)])
                    share = np.array([k["size"] for k in kids], float)
                    parts = rng.multinomial(np.asarray(mine, np.int64), share / share.sum())
                    yield pd.DataFrame({"node": [k["child"] for k in kids], "draws": list(parts.T)})

        joined = grouped.join(node, F.col("of") == F.col("node")).select("of", "draws", "kids")
        node = joined.mapInPandas(split, "node long, draws array<long>")
    return node.withColumnRenamed("node", "leaf")


def leaf_weights(leaf: int, draws, m, seed: int) -> np.ndarray:
    """replicates x rows: a leaf's draws split over its rows."""
    m = np.asarray(m, float)
    return np.random.default_rng([seed, 1 << 32, int(leaf)]).multinomial(np.asarray(draws, np.int64), m / m.sum())


def weighted_blocks(drawn: DataFrame, seed: int) -> DataFrame:
    """BLOCKS with the weights instead of the draws: ``w``, replicates x rows
    of unsigned integers of ``w_bytes`` bytes, compressed."""
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1)
                leaf, m, draws = (block[c][0] for c in ("leaf", "m", "draws"))
                weights = leaf_weights(leaf.as_py(), draws.values.to_numpy(), m.values.to_numpy(), seed)
                size = np.min_scalar_type(weights.max(initial=0)).itemsize
                packed = pa.compress(weights.astype(f"u{size}").tobytes(), codec="zstd", asbytes=True)
                columns = [block[f.split()[0]] for f in BLOCKS.split(", ")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([packed], pa.binary()), pa.array([size], pa.int32())],
                                                 names=[f.split()[0] for f in WEIGHTED.split(", ")])

    return drawn.mapInArrow(weigh, WEIGHTED)


def block_weights(w: bytes, w_bytes: int, replicates: int, n_rows: int) -> np.ndarray:
    """replicates x rows of a weighted block."""
    raw = pa.decompress(w, decompressed_size=replicates * n_rows * w_bytes, codec="zstd")
    return np.frombuffer(raw, f"u{w_bytes}").reshape(replicates, n_rows)


def row_weights(leaf: int, draws, m, seed: int) -> np.ndarray:
    """rows x replicates: a leaf's draws split over its rows."""
    return leaf_weights(leaf, draws, m, seed).T.astype(np.float64)


def drawn_blocks(df: DataFrame, label: str, features: Sequence[str], replicates: int, seed: int, leaf: int = LEAF) -> DataFrame:
    """BLOCKS and ``draws`` of each leaf."""
    blocks, bits = row_blocks(df, label, features, leaf)
    drawn = leaf_draws(blocks, bits, replicates, seed).withColumnRenamed("leaf", "_leaf")
    return blocks.join(drawn, F.col("leaf") == F.col("_leaf")).drop("_leaf")
