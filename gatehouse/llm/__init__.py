"""Training-data operators: search, sharding, mixing, filtering, tokenising.

Nothing outside this package imports it. Functions that run in Python workers
are shipped by value, so executors need the third-party libraries only, not
this repository on their path.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
