"""Operators for cleaning text corpora: filters, extraction, scans, near-duplicates, packing.

Nothing outside this folder imports it. Its Python functions travel to the
executors by value, so a cluster needs no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
