"""Operators for preparing large text collections for model training.

Code of this package is shipped to the executors with each job, so that they
need no installation of it: functions are pickled by value.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
