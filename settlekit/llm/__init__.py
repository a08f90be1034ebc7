"""Operators of a large-scale training-data pipeline (text, pages, vectors).

Nothing else in the package imports this one; ``__spark_entry__`` adds its
queries when it is there.
"""

from pyspark import cloudpickle as _cloudpickle

# Functions of this package travel to executors by value, so a cluster needs no installed copy of it.
_cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["_"]))
