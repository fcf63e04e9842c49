"""Operators for training-data pipelines. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Workers get these modules with the task, so that they need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
