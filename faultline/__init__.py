"""Log analytics and incident response as Spark DataFrame operators.

Every public function takes DataFrames (or Columns) and returns a DataFrame (or
Column).  Results are lazy unless a docstring says that jobs are started.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few Python functions that run in tasks travel with the plan, so executors
# need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
