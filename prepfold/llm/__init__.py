"""Operators of a training-data pipeline, one module per operator.

Nothing outside this subpackage imports it. Functions that run inside Spark
tasks are pickled by value, so the executors need the third-party libraries
but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
