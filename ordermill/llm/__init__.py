"""Operators for preparing training text.

Functions of this package travel to executors by value, so executors need only the libraries, not
a copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
