"""Queries of the engine's operators on the driver's tables, each with its SQL where SQL can say it."""

from . import incremental, linking, rules, scans, searching, summaries, titles
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "incremental", "linking", "rules", "scans", "searching", "summaries", "titles"]
