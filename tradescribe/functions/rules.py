"""Building blocks for decision tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, functions as F


def first_match(rules: Iterable[tuple[Column, Any]], otherwise: Any = None) -> Column:
    """Value of the first rule whose condition is true; unknown counts as not true."""
    decided = None
    for condition, value in rules:
        decided = F.when(condition, value) if decided is None else decided.when(condition, value)
    return F.lit(otherwise) if decided is None else decided.otherwise(otherwise)


def lookup(key: Column, table: Mapping[str, Any], otherwise: Any = None) -> Column:
    """Value listed for ``key``; a NULL key takes the default."""
    return first_match([(key == code, value) for code, value in table.items()], otherwise)


def any_of(conditions: Iterable[Column]) -> Column:
    """Three-valued OR."""
    joined = None
    for condition in conditions:
        joined = condition if joined is None else joined | condition
    return joined
