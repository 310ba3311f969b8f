"""Ordered-dataflow operators on Spark tables and Structured Streaming queries."""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors whole, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
