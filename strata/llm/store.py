"""Intermediate tables and connected components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the query that wrote them has ended, not when the
    driver happens to collect its garbage.  For queries whose result is
    written: nothing reads their shuffles again."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: the
    lineage ends there, and losing executors costs no more than their tasks.
    What is returned reads that table: it stays until ``discard`` (or the
    cluster's own clean-up of the folder)."""
    return _written(df, name)[0]


def discard(*tables: DataFrame) -> None:
    """Delete the files of ``stored`` tables that nothing reads any more."""
    for df in tables:
        for folder in {path.rsplit("/", 1)[0] for path in df.inputFiles()}:
            discard_folder(df.sparkSession, folder)


class Scratch:
    """Tables stored for the time of a ``with`` block, deleted at its end or
    when they are dropped."""

    def __enter__(self) -> "Scratch":
        self.tables: list[tuple[DataFrame, str]] = []
        return self

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        table, path = _written(df, name)
        self.tables.append((table, path))
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Delete what nothing reads any more."""
        for table, path in [x for x in self.tables if any(x[0] is t for t in tables)]:
            discard_folder(table.sparkSession, path)
        self.tables = [x for x in self.tables if not any(x[0] is t for t in tables)]

    def __exit__(self, *_) -> None:
        self.drop(*(table for table, _ in self.tables))


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component): for each id of the links (a, b) the least id that can
    be reached.  Every round an id takes the least label of its neighbours and
    then its label's label; it ends when no label moves.  Labels are summed up
    before they are shuffled, so an id with many links is no heavy task."""
    both = scratch.stored(links.select("a", "b").union(links.select("b", "a")).toDF("a", "b").where("a <> b").distinct(), "links")
    labels = scratch.stored(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
                            .select("id", F.least("id", "m").alias("component")), "labels")
    if labels.isEmpty():
        return labels
    labels_table = labels
    while True:
        near = (both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("component").alias("m")))
        low = labels.join(near, labels.id == near.a).select("id", F.col("component").alias("was"), F.least("component", "m").alias("component"))
        of = low.select(F.col("id").alias("l"), F.col("component").alias("ll"))
        jumped = low.join(of, low.component == of.l).select("id", "was", F.least("component", "ll").alias("component"))
        moved = scratch.stored(jumped, "labels")
        scratch.drop(labels_table)
        labels_table, labels = moved, moved.select("id", "component")
        if moved.where("component < was").isEmpty():
            scratch.drop(both)
            return labels
