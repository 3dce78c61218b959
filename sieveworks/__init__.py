"""A PySpark-native engine that generates, curates and checks training datasets.

Python functions that run on the executors are shipped by value, so a cluster
needs no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
