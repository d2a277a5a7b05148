"""Training-data operators: scoring, deduplication, decontamination, packing.

Functions of this package go to the executors by value, so these need its libraries but
not the package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
