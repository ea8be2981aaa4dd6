"""Operators for preparing training text, each a DataFrame → DataFrame function.

Nothing else in the library imports this package.  Its functions travel to the executors by value,
so a cluster needs no copy of it there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
