"""txflow: transaction ingest, reconciliation and fraud analytics on PySpark."""

import sys

from pyspark import cloudpickle

# Task-side helpers travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
