"""Training-data operators. Nothing outside this package and ``corpus_pipeline.py`` imports it.

Functions that run inside Spark tasks are shipped by value, so executors need the
third-party libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
