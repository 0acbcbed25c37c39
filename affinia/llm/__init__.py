"""Operators for preparing training data for language models; nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value: these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
