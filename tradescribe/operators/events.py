"""Lifecycle event and basket fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def event_field(name: str) -> Column:
    """A value reported only where a valuation method is given."""
    return F.when(F.col("M_VAL_METHOD").isNotNull(), F.col(name))


def event_identifier() -> Column:
    return event_field("M_COMPRES_ID")


def event_timestamp() -> Column:
    return event_field("HS_EXEC_TIME")
