"""Operators for preparing training text: deduplication, filters, classifiers and packing. Nothing else imports this."""

import sys

from pyspark import cloudpickle

# Functions travel to the tasks with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
