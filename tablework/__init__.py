"""Spark-native table analytics: DataFrame-in / DataFrame-out operators."""

import sys

from pyspark import cloudpickle

# Helpers called inside tasks travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
