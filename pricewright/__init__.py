"""Tabular price analytics and regression as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their own code, so the package need not be
# installed on the workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
