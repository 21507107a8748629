"""Operators for preparing large training corpora.

Nothing outside this package imports it. Its functions travel to the executors
by value, so the package needs no installation there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
