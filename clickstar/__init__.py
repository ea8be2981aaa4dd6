"""Clickstream-to-star-schema operators and jobs on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The few Python helpers travel to the executors with the job, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
