"""The registered queries and, where SQL can say the same, their oracle SQL."""

from tasteloom.registry import (  # noqa: F401
    cleaning,
    evaluating,
    exploring,
    featuring,
    keeping,
    modelling,
    profiling,
    relating,
    serving,
    storing,
)
from tasteloom.registry.book import BOOK

__all__ = ["BOOK"]
