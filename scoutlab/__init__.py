"""scoutlab — Spark-native analytics for sports market-value tables and
chess puzzle difficulty.

Every public operator takes and returns ``pyspark.sql.DataFrame`` objects
plus column names; nothing is collected to the driver except tiny,
bounded results (loop-termination counters, one-row statistics).
"""

from scoutlab.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors need
# no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
