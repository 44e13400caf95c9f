"""Operators that prepare training data: dedup, scoring, mixing, packing, encoding.

Functions of this package travel to the executors by value, so a cluster needs
only the public libraries installed, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
