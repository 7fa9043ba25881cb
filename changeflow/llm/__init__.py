"""Operators for preparing training data. Nothing else in the library imports this package.

Functions of this package travel to the executors by value, so a job needs no copy of the
library on the machines that run its tasks.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
