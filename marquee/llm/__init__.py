"""Operators for preparing training data; nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# tasks get this package's functions with their code, so executors need no copy of the repository
cloudpickle.register_pickle_by_value(sys.modules[__name__])
