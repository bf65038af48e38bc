"""Operators for training-data pipelines; nothing else in the library imports this subpackage.

Functions that run inside tasks are sent to the executors by value, so that only the driver
needs the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
