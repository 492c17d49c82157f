"""Operators for preparing training text, and the queries that apply them."""

import sys

from pyspark import cloudpickle

# Tasks carry these modules' code with them: executors need numpy, pyarrow and xxhash, not the
# package itself.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
