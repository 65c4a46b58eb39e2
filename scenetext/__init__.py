"""Scene compositing and text analytics as Spark DataFrame jobs.

Functions take DataFrames and return DataFrames; Spark plans and runs them.
"""

import sys

from pyspark import cloudpickle

# Arrow functions of this package travel to the executors by value, so a
# cluster needs no copy of it on the workers' path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
