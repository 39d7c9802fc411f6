"""Operators for preparing training text: scans, de-duplication, mixing, tokens, models and search.

Python code that runs in tasks is sent with the job, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
