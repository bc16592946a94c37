"""Operators of a training-data pipeline over documents, conversations and embeddings."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors with the job, which therefore need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
