"""Operators of a training-data pipeline: language identification, URL
filters, exact and near deduplication, scoring, mixing and packing.

Nothing else in ``strata`` imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Tasks get functions of this subpackage by value: executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
