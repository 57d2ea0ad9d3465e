"""Question answering over documents and relational tables, as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# The few functions that run inside tasks travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
