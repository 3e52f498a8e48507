"""Text triage and rater agreement as Spark DataFrame operations."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the task, so executors
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
