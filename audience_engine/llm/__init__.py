"""Operators for preparing training data: one module per operator, plus the
queries that the driver registers (``queries.py``).  Nothing else in the
library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
