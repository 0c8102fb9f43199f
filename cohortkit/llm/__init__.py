"""Operators for preparing training text at scale: archives, secret scans,
tokenizing, decontamination, passage and near-duplicate search, language and
toxicity scores.

Nothing else in the library imports this package.  Its Python functions are
shipped to executors by value, so executors need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
