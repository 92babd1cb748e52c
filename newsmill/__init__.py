"""newsmill: mining web-news text at scale with PySpark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the job, so the package need not be
# installed or importable there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
