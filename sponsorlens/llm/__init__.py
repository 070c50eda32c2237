"""Training-data operators: ten corpus operators and the queries over them.

Nothing else in the library imports this package. Its functions run inside
Spark's Python workers, which need not have the repository on their path, so
the package is pickled by value.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
