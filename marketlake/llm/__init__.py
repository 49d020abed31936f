"""Operators of a training-data pipeline and their queries; nothing else in the package imports this one."""

from marketlake.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
