"""Spark-native analytics for transaction-risk tables."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Task functions travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
