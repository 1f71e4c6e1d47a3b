"""Operators that prepare text corpora for model training.

Nothing else in the library imports this subpackage.  Its functions are shipped to
executors by value, so a worker needs no copy of the package on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
