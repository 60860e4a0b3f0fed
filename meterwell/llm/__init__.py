"""Operators for preparing training corpora, one module each.

Their Python functions travel to the executors by value, so executors need no copy of
this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
