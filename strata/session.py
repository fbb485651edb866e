"""Spark session defaults and the shared checkpoint location.

On a cluster the session already exists and names its checkpoint folder in
``spark.checkpoint.dir``; we only read it.  Tests and local runs start their
own session and may set a scratch folder when none is configured.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

# Settings this library relies on.  AQE re-plans joins from runtime sizes
# (its broadcast decision is a checked size, capped by the threshold below),
# splits skewed sort-merge partitions and coalesces small shuffle partitions.
# A Python worker gets rows in batches of some bytes: Spark's bound of 10,000
# rows may be all blocks of a partition at once, held by the executor and by
# its worker, more of them the larger the tables are.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "strata", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the SQL settings above to a session someone else built, where
    that session leaves them open."""
    chosen = spark.conf.getAll
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql.") and k not in chosen:
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session.  Where it is unset,
    ``fallback`` is taken, or in local mode, where the driver's folders are
    the executors', a fresh folder under ``$STRATA_SCRATCH`` or ``/tmp``.  On
    a cluster an unset folder raises: executors would each write to their own
    disk.
    """
    sc = spark.sparkContext
    configured = (sc.getCheckpointDir()
                  or sc.getConf().get("spark.checkpoint.dir", None)
                  or spark.conf.get("spark.checkpoint.dir", None))
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not fallback and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir is unset: it has to name a folder that all executors share")
    base = fallback or os.path.join(os.environ.get("STRATA_SCRATCH", "/tmp"), f"strata-ckpt-{uuid.uuid4().hex[:12]}")
    sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path inside the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def spread(df):
    """Spread the rows of ``df`` evenly, over twice the cores or as many
    partitions as the session shuffles to, whichever is more.  For work that
    multiplies per row (B bootstrap replicates per row) this pays: the shuffle
    moves each row once, the work that follows is B times larger."""
    spark = df.sparkSession
    return df.repartition(max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
