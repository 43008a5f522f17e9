"""Operators for large training-data corpora (language ID, deduplication,
scoring, tokenisation, packing, sharding, nearest neighbours).

Nothing else in the library imports this subpackage.  Its functions travel to
the executors by value, so executors need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
