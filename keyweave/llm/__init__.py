"""Operators of a training-data pipeline over tables of documents and vectors.

Nothing else in the library imports this subpackage. Functions that run in tasks are sent by value,
so executors need only the Python packages named in the README, not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
