"""Spark jobs for polled feeds: land, type, tag, derive, load, audit, ask, compare."""

from .session import prepare, shared_dir
from .spec import Contract, ContractColumn, FeedSpec, Field

__all__ = ["Contract", "ContractColumn", "FeedSpec", "Field", "prepare", "shared_dir"]
