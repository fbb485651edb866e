"""Python workers find this package where the driver runs it from a folder.

Installed packages and ``--py-files`` need none of this; a checkout does,
where executors see the same folder (local runs, a shared mount)."""

from __future__ import annotations

import os

import strata

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def importable(spark) -> None:
    """Put the folder of the package on the workers' Python path."""
    home = os.path.dirname(os.path.dirname(os.path.abspath(strata.__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        env["PYTHONPATH"] = os.pathsep.join([home, *paths])


def small_batches(spark) -> None:
    """Bound what a Python worker gets at once by bytes, where the session
    leaves that open: 10,000 rows, Spark's bound, may be 10,000 long texts, held
    by the executor, by its worker and as what the worker makes of them."""
    if BATCH not in spark.conf.getAll:
        spark.conf.set(BATCH, str(BATCH_BYTES))
