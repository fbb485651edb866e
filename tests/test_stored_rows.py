"""Batched fits store their rows before tasks stream several partitions."""

import numpy as np
import pytest

from strata.operators import bootstrap


@pytest.mark.parametrize("how", ["grid", "cv", "exact"])
def test_rows_are_stored_before_tasks_stream_partitions(spark, how, monkeypatch):
    """No join or sort below the coalesced tasks: a task would hold those of all
    its partitions until it ends."""
    rng = np.random.default_rng(2)
    rows = spark.createDataFrame([(i, int(rng.random() < 0.4), float(rng.random()), i % 3) for i in range(300)], "id long, y int, a double, f int")
    joined = rows.join(rows.select("id").distinct(), "id")
    seen, real = [], bootstrap._newton

    def newton(data, *args, **kw):
        seen.append(data._jdf.queryExecution().executedPlan().toString())
        return real(data, *args, **kw)

    monkeypatch.setattr(bootstrap, "_newton", newton)
    if how == "grid":
        bootstrap.grid_logreg(joined, ["a"], "y", "id", [1.0, 0.5])
    elif how == "cv":
        bootstrap.cv_logreg(joined, ["a"], "y", "id", "f", 3)
    else:
        bootstrap.bootstrap_logreg(joined, ["a"], "y", "id", replicates=3, draws="exact")
    stored, _, below = seen[0].partition("InMemoryRelation")
    assert "Coalesce" in stored and "Join" not in stored and "Coalesce" not in below
