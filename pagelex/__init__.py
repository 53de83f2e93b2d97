"""Functions of this package are pickled by value, so that executors need no copy of it on their path."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
