"""Operators of a training-data pipeline: near and exact duplicates, quality,
mixing, packing, licences, token counts, nearest neighbours, URL lists and
language-model scores.  Nothing else in the library imports this subpackage.

Functions that run inside tasks are sent by value, so executors need no copy of
this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
