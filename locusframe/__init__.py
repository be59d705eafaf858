"""locusframe: germline cohort analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle as _cloudpickle

# Functions of this package used inside pandas UDFs / mapInPandas are pickled
# by value, so executors need no installed copy of the package.
_cloudpickle.register_pickle_by_value(sys.modules[__name__])
