"""Operators for training-data corpora. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their own code: workers need not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
