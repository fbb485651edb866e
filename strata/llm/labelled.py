"""Labelled rows for fitting a classifier, and the held-out fold."""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True on the fold that no classifier learns from: crc32 of the id's
    text modulo 5 is 0.  A null id is in no fold (False)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int]):
    """(doc_id, text, label) of about ``per_class[y]`` documents of each class
    y (all, if fewer), and the number of labelled documents of each class.

    Only rows outside the held-out fold are read.  A document labelled more
    than once takes its largest label; rows with a null id or label are left
    out.  A class keeps the documents whose id's hash lies below the share
    that its bound is of its count, so the sample depends on neither order nor
    partitions.  Its ids are bounded by ``per_class``, hence the broadcast; of
    rows that share an id the least text is taken, so its rows are bounded too.
    """
    rows = (labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("label"))
            .where(F.col("doc_id").isNotNull() & F.col("label").isin(list(per_class)) & ~held_out())
            .groupBy("doc_id").agg(F.max("label").alias("label")))
    rows = rows.join(docs.select("doc_id"), "doc_id", "left_semi")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}  # one row a class
    spark, span = docs.sparkSession, 1 << 30
    taken = [(F.col("label") == y) & (F.pmod(F.xxhash64("doc_id"), F.lit(span)) < span * min(1.0, per_class[y] / n))
             for y, n in counts.items()]
    ids = rows.where(reduce(or_, taken)).collect() if taken else []
    # by Arrow: rows of Python objects would take Python workers of their own on the executors
    picked = spark.createDataFrame(pa.table({"doc_id": pa.array([r["doc_id"] for r in ids], pa.int64()),
                                             "label": pa.array([r["label"] for r in ids], pa.int32())}))
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")), counts


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30.0, 30.0)))
