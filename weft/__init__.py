"""Spark DataFrame operators for text, files, tables, joins and aggregates."""

import sys

from pyspark import cloudpickle

# Functions for Python workers travel with their task, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
