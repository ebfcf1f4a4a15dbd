"""Training-data operators: each module holds one operator, ``queries`` registers them."""

import sys

from pyspark import cloudpickle

# functions go to the executors whole, so that these need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
