"""Corpus text to tokens, training windows and token distributions on Spark."""

import sys

from pyspark import cloudpickle

# Tasks carry the few functions they run, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
