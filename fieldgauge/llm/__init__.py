"""Operators for training-data pipelines. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with the task, so that executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
