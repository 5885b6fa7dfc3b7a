"""Operators of a training-data pipeline: tokens, toxicity, secrets, duplicates, quality, archives, chats, packing."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value: the workers need numpy and pandas, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
