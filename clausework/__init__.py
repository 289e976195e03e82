"""clausework: clause labelling and stance as Spark DataFrame jobs.

Layout: ``functions`` (Column expressions), ``operators`` (DataFrame ->
DataFrame steps), ``sources`` (readers, sinks, driver-table mapping),
``plans`` (end-to-end pipelines and the driver query registry),
``streaming`` (micro-batch runner for the stateless steps).

Functions that run in Python workers (the list parser's slow path, plug-in
tokenizers and models) are pickled by value, so executors need no install
of this package.
"""

import sys as _sys

__version__ = "0.1.0"

try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # an older cloudpickle: workers then import the package
    pass
