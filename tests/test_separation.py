import numpy as np
import pytest

from strata.operators import models as M
from strata.operators.separation import find_separation

COLS = "y int, a double, b double, c double"


def frame(spark, x, y):
    return spark.createDataFrame([(int(l), *map(float, r)) for l, r in zip(y, x)], COLS)


def clean(seed=1, n=500):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    return x, rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] - 0.5 * x[:, 1])))


def right_side(x, y, found):
    margin = np.where(y, 1, -1) * (found.direction[0] + x @ np.array(found.direction[1:]))
    return margin.min() >= -1e-6 and margin.max() > 0, margin.min() > 0


def test_clean_data_pass(spark):
    x, y = clean()
    df = frame(spark, x, y)
    for intercept in (False, True):
        assert find_separation(df, ["a", "b", "c"], "y", intercept) is None
        rows, extra = M.logit_inference(df, ["a", "b", "c"], "y", intercept)
        assert len(rows) == 3 + intercept
    assert find_separation(frame(spark, x[:, :1] * [[1e6, 1e-6, 1]] + x * [[0, 0, 1]], y), ["a", "c"], "y") is None  # other units
    strong = np.random.default_rng(2).normal(size=(2000, 3))
    label = np.random.default_rng(3).random(2000) < 1 / (1 + np.exp(-9 * strong[:, 0]))  # a strong signal separates nothing
    assert find_separation(frame(spark, strong, label), ["a", "b", "c"], "y", True) is None


def test_complete_separation(spark):
    x, _ = clean(4)
    y = x[:, 0] + 0.7 * x[:, 1] > 0
    x[:, :2] += np.where(y, 0.2, -0.2)[:, None]  # a gap
    found = find_separation(frame(spark, x, y), ["a", "b", "c"], "y")
    assert found.kind == "complete" and set(found.columns[:2]) == {"a", "b"} and all(right_side(x, y, found))
    with pytest.raises(ValueError, match="complete separation by"):
        M.logit_inference(frame(spark, x, y), ["a", "b", "c"], "y")


def test_one_value_of_one_class(spark):
    """A 0/1 column that is 1 only in rows of label 1: quasi-complete."""
    x, y = clean(5)
    x[:, 2] = (np.arange(500) % 7 == 0) & y
    for intercept in (False, True):
        found = find_separation(frame(spark, x, y), ["a", "b", "c"], "y", intercept)
        assert found.kind == "quasi-complete" and found.columns == ("c",) and right_side(x, y, found) == (True, False)
    with pytest.raises(ValueError, match="quasi-complete separation by c$"):
        M.logit_inference(frame(spark, x, y), ["a", "b", "c"], "y")


def test_two_columns_together(spark):
    """Neither column separates; their difference does on the rows where it is not 0."""
    rng = np.random.default_rng(6)
    x, y = clean(6)
    x[:, 1] = rng.integers(0, 3, 500)
    x[:, 2] = x[:, 1] + np.where(rng.random(500) < 0.3, np.where(y, 1, -1), 0)
    found = find_separation(frame(spark, x, y), ["a", "b", "c"], "y", True)
    assert found.kind == "quasi-complete" and set(found.columns) == {"b", "c"} and right_side(x, y, found)[0]


def test_one_class_and_no_rows(spark):
    x, y = clean(7)
    found = find_separation(frame(spark, np.abs(x), np.ones(500)), ["a", "b", "c"], "y")
    assert found.kind == "complete"
    assert find_separation(frame(spark, x, np.ones(500)), ["a", "b", "c"], "y", True).kind == "complete"  # by the intercept
    assert find_separation(frame(spark, x[:0], y[:0]), ["a", "b", "c"], "y") is None
