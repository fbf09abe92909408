"""Spark-first engine for scanned case records: sources, operators, functions, plans, streaming."""

from paperloom.session import build_session, cut_lineage
from paperloom.tables import read_table

__all__ = ["build_session", "cut_lineage", "read_table"]
