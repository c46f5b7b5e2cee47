"""reelrank: review-based recommendations written as Spark DataFrame plans.

Every operator is a function ``DataFrame(s) -> DataFrame``; nothing is
collected to the driver except one-row aggregates and size checks.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python functions run inside tasks (applyInPandas) are shipped by value,
# so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
