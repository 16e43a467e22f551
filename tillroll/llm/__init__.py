"""Operators of a training-data pipeline: filtering, dedup, packing, encoding, search."""

import sys

from pyspark import cloudpickle

# Functions that run in executor tasks travel by value, so a cluster needs no
# copy of this package on its Python workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
