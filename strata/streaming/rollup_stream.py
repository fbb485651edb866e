"""The sales roll-up as an incremental Structured Streaming job.

New sales files arrive in a folder.  Each micro-batch is reduced to level-1
partials — one row per (region, country, customer) with exact DECIMAL sums,
flags and the last date (``customer_partials``) — and written to its own
folder ``epoch=<id>`` in overwrite mode: a micro-batch replayed after a
failure rewrites the same folder, so the partial table is exactly-once.
Reading the roll-up merges the partials per customer (sums add, flags and
dates take the maximum) and runs level 2, which gives exactly the batch
answer, because every level-1 column is decomposable.

``count(DISTINCT ...)`` is not supported in streaming aggregations; the
two-level form needs none, and the state kept between batches is the
partial table itself (bounded by customers x micro-batches, compacted by
``compact_partials``), not an ever-growing per-row state store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.operators.rollup import (
    Periods, customer_partials, merge_partials, rollup_from_customers,
)

KEYS = ("region", "country")


def start_incremental_rollup(spark: SparkSession, source_dir: str, schema, partials_path: str,
                             checkpoint_path: str, periods: Periods, keys=KEYS,
                             max_files_per_trigger: int | None = None, available_now: bool = True):
    """Start the stream; returns the StreamingQuery."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    keys = list(keys)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        base = batch.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
        (customer_partials(base, periods, keys)
         .write.mode("overwrite").parquet(f"{partials_path}/epoch={epoch_id}"))

    writer = (stream.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="30 seconds")
    return writer.start()


def read_rollup(spark: SparkSession, partials_path: str, periods: Periods, keys=KEYS) -> DataFrame:
    """The roll-up over everything the stream has processed so far."""
    partials = spark.read.parquet(partials_path).drop("epoch")
    return rollup_from_customers(merge_partials(partials, keys), periods, keys)


def compact_partials(spark: SparkSession, partials_path: str, compacted_path: str,
                     keys=KEYS) -> None:
    """Merge all epochs into one row per customer (run between streams)."""
    merge_partials(spark.read.parquet(partials_path).drop("epoch"), keys) \
        .write.mode("overwrite").parquet(compacted_path)
