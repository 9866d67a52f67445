"""tessera: vector, series and label analytics expressed as Spark DataFrame jobs.

Sub-packages
------------
sources    readers, sinks and record parsing
functions  Column-level helpers (vector math, byte codecs, rounding)
operators  DataFrame -> DataFrame operators (stats, decomposition, clustering, judging, ...)
plans      stand-in tables built from the driver tables, and the query registry
streaming  incremental (Structured Streaming) forms of the additive statistics
"""

__version__ = "0.1.0"

# Functions shipped to Python workers (mapInPandas / applyInPandas / pandas UDF bodies) are
# pickled by value, so executors need no copy of this package on their import path.
try:  # pragma: no cover - depends on the pyspark build
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
