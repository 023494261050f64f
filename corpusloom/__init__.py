"""corpusloom: a Spark-native engine that turns raw pages into a clean sentence corpus."""

from pyspark import cloudpickle as _cloudpickle

# Python workers get this package's functions by value, so executors need no copy of it on their path.
_cloudpickle.register_pickle_by_value(__import__(__name__))

__version__ = "0.1.0"
