"""Operators for preparing training text. Nothing else in the library imports this package.

Functions that run in tasks are sent to the workers by value, and so are broadcast models (staging.send), so a worker
needs no copy of this package on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
