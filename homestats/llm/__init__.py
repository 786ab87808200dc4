"""Operators for training-data pipelines: mixing, search, scans, dedup, packing, archives.

Nothing else in the library imports this subpackage. Functions that run inside
Python workers are shipped by value, so executors need Spark, Arrow and numpy
but no copy of this package.
"""

from __future__ import annotations

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
