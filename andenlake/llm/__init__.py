"""Operators for preparing training text. Nothing else in the library imports this package.

Functions that run inside Python workers are pickled by value, so executors need
no copy of this package, only numpy, pandas, pyarrow and the libraries named in
each module.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
