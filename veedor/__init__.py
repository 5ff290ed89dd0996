"""A Spark-first data-quality and ingestion engine for catalogue records."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value, so these need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
