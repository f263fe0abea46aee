"""Training-data operators (nothing else in the library imports this subpackage).

Functions of this package run inside Spark tasks.  They are pickled by value, so executors need
no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
