"""Operators of a training-data pipeline: filtering, deduplication, search, extraction and packing."""

import sys

from pyspark import cloudpickle

# Python workers get the functions of this package with each task, so executors need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])
