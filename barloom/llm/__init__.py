"""Operators for preparing training corpora of documents and conversations."""

import sys

from pyspark import cloudpickle

# The functions that run in Python workers travel with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
