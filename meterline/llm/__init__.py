"""Operators that prepare training data: quality, privacy, duplicates, mixing, sharding, formatting."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the tasks, so that only the driver needs it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
