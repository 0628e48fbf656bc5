"""Operators for preparing language-model training data, each a set of Spark jobs.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the job, so the cluster's Python
# needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
