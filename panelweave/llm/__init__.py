"""Operators of a training-data pipeline: archives, contamination, duplicates, quality, secrets, packing."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no installed copy of the package
