"""Operators of a training-data pipeline, each a Spark job over whole tables.

Nothing else in the library imports this subpackage.  Its functions travel to
the executors by value, so the package need not be installed there."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
