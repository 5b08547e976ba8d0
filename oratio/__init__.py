"""oratio: speech enrichment as Spark DataFrame operators."""

import sys as _sys

# Functions of this package that run in Python workers (mapInPandas, pandas UDFs) are shipped
# by value, so executors need no installed copy of the package.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: fall back to --py-files
    pass
