"""Operators for preparing training text; nothing else in the library imports this subpackage."""

from . import queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
