"""Operators for large text corpora: filtering, deduplication, tokenisation.

Functions of this package run inside Spark's Python workers. They are shipped
by value, so the workers need numpy and pyarrow but not this package on their
path.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
