"""Vector, text and hybrid retrieval on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of this package that run inside tasks travel with the job, so
# executors need nothing installed beyond numpy and pyarrow.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
