"""Scalar functions as Column expressions, Arrow functions where a loop or a tree is needed."""

import sys

from pyspark import cloudpickle

# Arrow functions travel by value, so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
