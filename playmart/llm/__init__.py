"""Training-data operators: one module per operator, registered by ``queries``.

Nothing else in the library imports this package. Functions that run inside
Python workers are pickled by value, so the workers need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
