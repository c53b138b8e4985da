"""tessera: corpus-building operators on Spark DataFrames.

Python UDFs of this package (translator, stemmer) are pickled *by value*, so
executors do not need the package installed or on their path.
"""

import sys as _sys

try:  # pragma: no cover - depends on the pyspark build
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
