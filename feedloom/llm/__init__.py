"""Training-data operators over whole corpora (documents, pages, embeddings).

Each module holds one operator with its own interface; ``queries`` has the
thin registered queries that derive the digest columns from them.

Functions of this subpackage that run in tasks are sent by value, so executors
need only the installed libraries, not this repository on their path."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
