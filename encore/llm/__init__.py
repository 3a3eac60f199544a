"""Operators of a training-data pipeline.

Every operator takes a table of documents (or conversations), reads only the
columns it names and keeps its own columns apart from those of the caller.
Functions that run in Python workers travel by value, so a cluster needs the
public packages they import but not this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
