"""Operators of a training-data pipeline.

Functions that run in executor tasks are shipped with the job (pickled by
value), so executors need the third-party libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
