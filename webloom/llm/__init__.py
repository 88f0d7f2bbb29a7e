"""Operators for large training-text corpora.

Every operator takes and returns DataFrames and can be used on its own; the registered queries
(``queries.py``) apply them to the ``documents`` table. Nothing else in the library imports this package.

Functions that run inside Python workers are shipped by value, so executors need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
