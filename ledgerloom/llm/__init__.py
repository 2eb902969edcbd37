"""Operators for preparing training data: thirteen operators, their queries and the corpus pipeline's parts.

Nothing else in the package imports this subpackage. Functions that run inside tasks travel by
value, so workers need numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
