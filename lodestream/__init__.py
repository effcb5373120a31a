"""lodestream: retrieval-data and serving-telemetry operators for PySpark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Kernels travel to the executors by value, so a worker needs no installed copy
# of this package and no particular working directory.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
