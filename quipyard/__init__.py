"""Preference-data engine on Spark: pages -> comments -> training pairs -> generations."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package travel to the executors with the job, so the package
# need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
