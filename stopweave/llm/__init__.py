"""Operators for preparing training corpora: filters, near-duplicates, mixing, sharding.

Functions that run inside tasks travel with the task, so that executors need
no copy of this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
