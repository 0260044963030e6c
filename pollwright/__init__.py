"""Survey question-answering analytics as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel by value, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
