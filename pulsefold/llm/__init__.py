"""Operators for preparing large text corpora. Nothing else in the package imports this one."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel to the executors with the tasks that use them, so the
# package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
