"""Training-data operators.  Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# executors get these functions by value: they need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
