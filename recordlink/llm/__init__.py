"""Operators for training-data pipelines, and their registered queries (``registry``)."""

import sys

from pyspark import cloudpickle

# Task functions of this package travel by value: executors need not be able to import it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
