"""Operators that prepare a text corpus for training language models.

Tasks get the functions of this package by value, so workers need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
