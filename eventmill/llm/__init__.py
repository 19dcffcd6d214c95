"""Operators for training-data pipelines: filtering, near-duplicate detection, extraction, mixing."""

import sys

from pyspark import cloudpickle

# The functions of these modules travel to the executors with the tasks, which need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
