"""Operators for training-data corpora. Nothing else in the package imports this folder.

The functions that run in tasks travel by value, so the workers need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
