"""Tessera: text-corpus analytics as lazy Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel by value, so that workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
