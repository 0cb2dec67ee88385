"""Predicates on the product hierarchy: family, group, product, UPI path."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tradescribe.functions.text import mentions


def family(*names: str) -> Column:
    return F.col("TRN_FMLY").isin(*names)


def group(*names: str) -> Column:
    return F.col("TRN_GRP").isin(*names)


def deal(family_name: str, *group_names: str) -> Column:
    """Trades of one family and any of the groups."""
    return family(family_name) & group(*group_names)


def product(*names: str) -> Column:
    return F.col("H_PRODUCT").isin(*names)


def trade_type(*names: str) -> Column:
    return F.col("TRN_TYPE").isin(*names)


def bought() -> Column:
    return F.col("H_BS") == "B"


def sold() -> Column:
    return F.col("H_BS") == "S"


def upi_mentions(*words: str) -> Column:
    """Case-sensitive search in the UPI path."""
    return mentions(F.col("HS_UPI"), *words)


def upi_mentions_folded(*words: str) -> Column:
    """Search in the UPI path in upper case."""
    return mentions(F.upper("HS_UPI"), *words)
