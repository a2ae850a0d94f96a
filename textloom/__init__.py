"""textloom: text-corpus preparation on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# UDFs carry their code along, so the workers of a cluster need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
