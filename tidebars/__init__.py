"""Price-bar analytics written as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel by value, so a cluster needs no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
