"""Operators for preparing training text. Nothing else in the library imports this package.

Task functions are sent to the executors with their code, so workers need no copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
