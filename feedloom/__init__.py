"""feedloom: bulk-feed ingestion, screening and load monitoring on Spark."""

import sys as _sys

try:
    # Ship the per-partition helpers (mapInPandas functions) by value, so executors
    # need no installed copy of this package or path setup.
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: fall back to shipping by reference
    pass

__version__ = "0.1.0"
