"""Timing-fault detection for dense sensor series, written as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to tasks carry their code with them, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
