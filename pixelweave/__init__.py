"""PySpark-native preparation and evaluation of labelled image and tensor datasets."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors inside the tasks that use them, so
# the package has to be installed on the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
