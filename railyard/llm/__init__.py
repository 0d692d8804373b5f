"""Operators for preparing large-scale training data.

Nothing outside this folder, ``corpus_pipeline.py`` and the guarded import in
``__spark_entry__.py`` uses it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so these need not
# have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
