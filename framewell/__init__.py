"""framewell: Spark-native operators for frame ingestion, change routing and
document-collection queries. Every operator takes and returns DataFrames."""

import sys as _sys

try:
    # Python-side closures (pandas UDFs, stateful processors) reference this
    # package; ship its code inside the pickled closures so executors need no
    # install of it.
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: rely on --py-files
    pass

__all__ = ["session", "schemas"]
