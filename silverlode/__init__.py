"""Silverlode: lakehouse data operators as plain PySpark DataFrame functions."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks are shipped by value: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
