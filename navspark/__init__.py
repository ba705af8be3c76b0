"""navspark: report flattening, contracts, NAV queries and training-data operators on Spark.

Every public function takes and returns DataFrames; none holds a session.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so a cluster
# needs no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
