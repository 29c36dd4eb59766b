"""Operators of a training-data pipeline over text, pages and embeddings.

Nothing else in the library imports this package. Each operator module offers plain
``DataFrame -> DataFrame`` functions; ``queries`` registers the thin ``opN_<name>`` queries.
"""

import sys

from pyspark import cloudpickle

# Python tasks get this package's functions by value, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
