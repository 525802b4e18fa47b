"""Operators of a large-scale training-data pipeline.

Each module holds one operator with its own general interface; ``queries``
binds them to the driver's tables. Nothing else in the library imports this
subpackage.
"""

import sys

from pyspark import cloudpickle

# Python workers may not have this package on their path: functions that run
# there carry their code. Broadcast values are plain data for the same reason.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
