"""bikeflow: snapshot-feed analytics for shared mobility on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Ship UDF code with the tasks, so executors do not need the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
