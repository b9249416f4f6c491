"""plumeline: DataFrame operators for building and checking satellite plume collections."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Group functions travel to the workers by value, so a cluster needs no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
