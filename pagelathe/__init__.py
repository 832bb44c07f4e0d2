"""Corpus preparation, retrieval and evaluation as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame.  Scalar helpers in
``functions`` take and return Columns.  ``plans`` strings operators together
into the jobs a user would run end to end.
"""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: its functions travel with the jobs.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
