"""Training-data operators: thirteen DataFrame-in, DataFrame-out jobs over document and vector tables."""

import sys

from pyspark import cloudpickle

# Task code travels with the task, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
