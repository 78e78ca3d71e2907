"""Registered queries over the given tables. Importing the package registers all of them."""

from . import audits, carried, cases, changes, ledgers, loads, partials, polls, questions, records
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "audits", "carried", "cases", "changes", "ledgers", "loads", "partials", "polls", "questions", "records"]
