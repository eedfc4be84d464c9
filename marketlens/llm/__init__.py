"""Operators of a training-data pipeline (one module per operator).

Nothing else in the library imports this subpackage. Its Python functions run
inside Spark tasks; registering the subpackage with Spark's pickler sends them
by value, so executors need no copy of it on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
