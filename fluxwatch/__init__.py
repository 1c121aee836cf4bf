"""fluxwatch: network-flow analytics as PySpark DataFrame transformations.

Every operator is ``DataFrame -> DataFrame``; the ones without ordering
requirements run unchanged on batch and on streaming DataFrames.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
