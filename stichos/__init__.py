"""Corpus analytics on Spark: annotated text, parallel layers and data checks as DataFrame operators."""

import sys

from pyspark import cloudpickle

# Executors get the package's functions with the tasks, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
