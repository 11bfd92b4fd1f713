"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage.

Functions that run in tasks are sent to the executors by value, so that only the driver needs
the library installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
