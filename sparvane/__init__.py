"""Spark-first preparation engine for measurement tables, reports and uncertainties."""

import sys

from pyspark import cloudpickle

# Functions for Python workers travel whole, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
