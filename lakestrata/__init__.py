"""Layered (bronze, validated/quarantine, silver, gold) data operations as Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python tasks travel with the job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
