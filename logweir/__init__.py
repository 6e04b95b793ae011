"""Click, access-log and event analytics as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions handed to Python workers travel with the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
