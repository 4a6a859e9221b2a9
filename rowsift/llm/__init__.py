"""Operators for building training data from text; nothing else in the library imports them."""

from rowsift.llm.queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
