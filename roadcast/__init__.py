"""Staging, profiling and enrichment of incident records on Spark DataFrames.

Functions that run inside Spark tasks are shipped by value, so executors need pyarrow and
numpy but not this package.
"""

import sys

from pyspark import cloudpickle

from roadcast.session import build_session
from roadcast.specs import BASIC, DATASETS, DETAILS, DatasetSpec

__all__ = ["BASIC", "DATASETS", "DETAILS", "DatasetSpec", "build_session"]

cloudpickle.register_pickle_by_value(sys.modules[__name__])
