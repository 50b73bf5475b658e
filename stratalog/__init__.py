"""Spark-native analytics for instruction corpora and depth-indexed measurement logs.

Every operator is a function ``DataFrame -> DataFrame`` built from native column expressions, so
Catalyst plans it. Tunable values live in the frozen dataclasses of :mod:`stratalog.config`.
"""

import sys

from pyspark import cloudpickle

# functions that run inside tasks travel with the job, so workers need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
