"""Operators and queries for training-data work; nothing else in the library imports them.

Functions of this package that run inside tasks are sent to the executors by
value, so a worker needs the installed libraries but not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
