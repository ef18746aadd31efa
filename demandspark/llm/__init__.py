"""Operators for preparing training text; nothing outside this folder imports it."""

from demandspark.llm.queries import ORACLE_SQL, QUERIES  # noqa: F401
