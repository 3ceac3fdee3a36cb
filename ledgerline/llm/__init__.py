"""Operators of a training-data pipeline over ``documents`` and ``pages``.

Nothing else in the library imports this package.  Functions that run on
executors are pickled by value, so executors need no copy of this code.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
