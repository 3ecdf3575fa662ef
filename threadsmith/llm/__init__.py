"""Training-data operators: ten DataFrame operators and the queries that apply them.

Functions of this package that run inside tasks are sent to the executors by value, so that these need no
copy of the package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
