"""Market-data and filings analytics as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Executors need no copy of this package: its column functions travel with the tasks that use them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
