"""Operators for preparing training data. Nothing else in the package imports this subpackage."""
from .queries import LLM_ORACLE, LLM_QUERIES

__all__ = ["LLM_QUERIES", "LLM_ORACLE"]
