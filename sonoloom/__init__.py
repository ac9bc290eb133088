"""Speech-corpus preparation and analytics as plain PySpark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
