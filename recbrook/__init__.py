"""recbrook: Spark-native feature engineering, retrieval and ranking for a
user/post recommender.

Every operator is a ``DataFrame -> DataFrame`` function built from the
DataFrame API so Catalyst can prune, push down and pick join strategies.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

__version__ = "0.1.0"

# Functions of this package travel to the Python workers by value, so workers
# need not be able to import it (a job started from any folder, any cluster).
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
