"""Recommendation analytics on Spark DataFrames.

Every operator takes DataFrames and returns DataFrames, so calls compose with
``df.transform(...)`` and Catalyst sees one plan.
"""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with the plan, so the
# executors do not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
