"""Operators a training-data pipeline needs; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# functions of this folder that run in tasks travel with the task, so executors need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
