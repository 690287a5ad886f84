"""Operators of a training-data pipeline: near-duplicates, privacy, tokens, rules, licences, scores, mixing, toxicity."""

import sys

from pyspark import cloudpickle

# tasks carry the code of this package with them, so executors need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])
