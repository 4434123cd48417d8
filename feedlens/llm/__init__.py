"""Operators of a large-scale training-data pipeline.

Nothing outside this subpackage imports it (``__spark_entry__`` adds its queries
only when it is there). The functions that run in Python workers are shipped by
value, so executors need no install of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
