"""strata: tabular roll-ups, grouped statistics, feature pipelines and
binary classifiers expressed as Spark DataFrame jobs."""

__version__ = "0.1.0"

# Ship this package's functions to Python workers by value, so that
# executors need no installed copy of it (mapInPandas helpers).
try:  # pragma: no cover - depends on the pyspark build
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
