"""Item-combination value, text tagging and posting analytics as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Executors need not have the package installed: its few task-side functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
