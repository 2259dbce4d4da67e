"""Operators for training-data corpora; nothing else in the library imports this.

Functions that run inside tasks travel with the tasks, so executors need no
installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
