"""Operators for preparing text corpora; nothing else in the library imports this folder."""

import sys

from pyspark import cloudpickle

# Executors get the functions themselves and need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
