"""Operators for preparing training data, each on DataFrames of any size.

Functions of this package that run inside tasks are pickled by value, so executors need
numpy, pyarrow and xxhash but not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
