"""Near-duplicate pruning of embedding tables, written for PySpark.

Every operator takes and returns DataFrames; :mod:`neardup.plans` composes
them into the whole pruning run.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Executors need no installed copy: functions of this package travel with the
# task closure.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
