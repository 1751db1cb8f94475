"""Operators for preparing language-model training data."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code along, so that it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
