"""Operators of a training-data pipeline (quality, dedup, mixing, packing,
language id, archives, token files, exact vector search), one module each.

Nothing else in the library imports this subpackage; ``registry`` holds the
queries and their SQL. Functions that run inside tasks are shipped by value,
so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
