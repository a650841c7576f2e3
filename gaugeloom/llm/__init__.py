"""Operators for preparing language-model training data, and the corpus pipeline's parts.

Nothing else in the package imports this one.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with them, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
