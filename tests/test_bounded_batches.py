"""what an executor and its Python workers hold of large rows does not
grow with a partition."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strata.operators import bootstrap
from strata.session import apply_runtime_conf


def test_batches_of_python_workers_are_bounded(spark):
    """300 rows of 100 KB in one partition, in what a query's session gives."""
    apply_runtime_conf(spark)
    rows = spark.range(300, numPartitions=1).withColumn("w", F.expr("repeat('x', 100000)"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "bytes": [sum(len(x.as_py()) for x in b["w"])]})

    found = rows.mapInArrow(sizes, "n long, bytes long").collect()
    assert sum(r["n"] for r in found) == 300 and max(r["bytes"] for r in found) <= 5 * 1024 * 1024


def test_weighted_blocks_are_stored_on_disk(spark, monkeypatch):
    """The cache in memory asks for room after every 16 batches of some MB."""
    rng, seen, near = np.random.default_rng(4), [], bootstrap._near
    rows = spark.createDataFrame([(i, int(rng.random() < 0.4), float(rng.random())) for i in range(400)], "id long, y int, a double")
    monkeypatch.setattr(bootstrap, "_near", lambda data, *a: seen.append(data._jdf.queryExecution().executedPlan().toString()) or near(data, *a))
    beta, _, converged = bootstrap.bootstrap_logreg(rows, ["a"], "y", "id", replicates=5, draws="exact")
    assert converged.all() and len(beta) == 5
    assert "StorageLevel(disk, 1 replicas)" in seen[0] and "memory" not in seen[0].split("InMemoryRelation")[1].split("StorageLevel(")[1].split(")")[0]
