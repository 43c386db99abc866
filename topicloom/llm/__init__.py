"""Operators of a training-data pipeline on Spark; nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the tasks by value, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
