"""Training-data operators: ten corpus operators and what they share.

Nothing outside this subpackage imports it.  Python functions that run on the
executors are shipped by value, so a cluster needs no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
