"""Case-document register engine on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions run by executors travel by value: workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
