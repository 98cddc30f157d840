"""Media recommendation and viewing analytics on Spark DataFrames."""

from viewloom.session import build_session, cut_lineage

__all__ = ["build_session", "cut_lineage"]
