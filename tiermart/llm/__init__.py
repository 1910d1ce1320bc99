"""Operators for large training-text corpora.

Nothing else in the library imports this subpackage. ``queries.py`` holds the
registered queries; each operator lives in a module of its own.
"""

import sys

from pyspark import cloudpickle

# Executors get the operators' functions with the job itself; they need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
