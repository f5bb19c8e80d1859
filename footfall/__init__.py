"""Product analytics for event logs, written as Spark DataFrame operators.

Every operator takes DataFrames and plain parameters and returns a DataFrame.
Nothing here reads the wall clock: each time-relative operator is given an
explicit ``as_of`` or an explicit date range, so a run can be repeated.
"""

import sys

from pyspark import cloudpickle

# Python functions sent to executors travel by value, so only the driver needs
# this package on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
