"""plotkeep: keep collections of tables and map layers current, versioned and checked, on Spark."""

import sys

from pyspark import cloudpickle

# The few Python functions travel to the executors by value, so a cluster
# needs no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
