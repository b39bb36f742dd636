"""Operators for preparing training data: one module each, and their queries."""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
