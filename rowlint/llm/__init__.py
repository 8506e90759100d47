"""Operators for large training-data pipelines.

Nothing else in the library imports this package.  Functions that run inside
tasks are pickled by value, so only the driver needs the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
