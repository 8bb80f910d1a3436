"""Operators of a training-data pipeline, one module each; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# functions travel to the executors with the job, so the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
