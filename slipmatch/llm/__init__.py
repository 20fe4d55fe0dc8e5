"""Operators for large text corpora, apart from the reconciliation engine.

Functions that run in tasks travel by value, so that executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
