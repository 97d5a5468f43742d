"""Batch and streaming retail warehouse jobs for Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The few functions and processors that run in Python workers travel with their job, so executors
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
