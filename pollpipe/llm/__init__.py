"""Operators for preparing training data, with their registered queries."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their code, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from . import queries  # noqa: E402
from .registry import ORACLES, QUERIES  # noqa: E402

__all__ = ["ORACLES", "QUERIES", "queries"]
