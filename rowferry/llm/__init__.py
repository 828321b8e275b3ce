"""Operators of a training-data pipeline. Nothing else in the package imports this subpackage.

Their Python functions travel to the executors by value, so nothing has to be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
