"""ticketlens — Spark-native text triage: text preparation, n-gram TF-IDF,
stratified folds, linear models, evaluation tables, run ranking and scoring."""

import sys as _sys

try:  # ship our Python functions (UDFs, pandas functions) by value to workers
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

__version__ = "0.1.0"
