"""Operators for preparing training data for language models.

Each module holds one operator with its general interface; ``registry`` has
the thin queries over the driver's tables.  Nothing else in the library
imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Executors need no copy of the package: its task functions travel with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
