"""Operators for training corpora. Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to the workers by value, so that a cluster needs no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
