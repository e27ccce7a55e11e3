"""Operators for training-data pipelines over `documents`, `pages`, `benchmark` and `labels`.

Functions of this package travel to the executors by value, so that a cluster needs no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
