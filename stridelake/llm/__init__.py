"""Operators of a training-data pipeline; nothing outside this subpackage imports them."""

import sys

from pyspark import cloudpickle

# tasks get the functions themselves, so that Python workers need not have the package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
