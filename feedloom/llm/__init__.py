"""Operations of a training-data pipeline; nothing else in the library imports this package."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions travel with their tasks: workers need not have the library on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
