"""Package fields.  All read the classifier PACKAGE_INDICATOR."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tradescribe.functions.rules import first_match, lookup
from tradescribe.operators.deals import product

# Notation names, spelled as the source spells them, and codes.
MONETARY = "Monetory Amount"
PRICE_NOTATION = {MONETARY: "1", "Decimal": "3"}
SPREAD_NOTATION = {MONETARY: "1", "Decimal": "3", "Basis points": "4"}


def _packaged() -> Column:
    return F.col("PACKAGE_INDICATOR") == "TRUE"


def _quoted_as(kind: str) -> Column:
    return F.col("M_PKG_TYP_R") == kind


def _notation(kind: str, codes: dict[str, str], otherwise: str | None) -> Column:
    """Code of the notation; a package of unknown kind counts as this kind."""
    coded = lookup(F.col("M_PKG_NOTA_R"), codes, otherwise)
    return F.when(_packaged() & F.coalesce(_quoted_as(kind), F.lit(True)), coded)


def package_id() -> Column:
    """Identifier of the package; numbers are whole, so their plain text is minimal."""
    contract = F.col("CONTRACT_NUMBER").cast("string")
    source = first_match(
        [
            (product("CURR_FXD_SWLEG"), contract),
            (F.col("H_PKG_LOG_ID") != "0", F.col("H_PKG_LOG_ID")),
            (F.col("PACKAGE") != 0, F.col("PACKAGE").cast("string")),
            (_quoted_as("FX Dual Ccy Capped"), contract),
        ]
    )
    return F.when(_packaged(), source)


def price() -> Column:
    return F.when(_packaged() & _quoted_as("Price"), F.col("M_PKG_VAL_R"))


def price_currency() -> Column:
    monetary = F.col("M_PKG_NOTA_R") == MONETARY
    return F.when(_packaged() & _quoted_as("Price") & monetary, F.col("M_PKG_CURR_R"))


def price_notation() -> Column:
    return _notation("Price", PRICE_NOTATION, "EROR")


def spread() -> Column:
    return F.when(_packaged() & _quoted_as("Spread"), F.col("M_PKG_VAL_R"))


def spread_currency() -> Column:
    return F.when(_packaged() & _quoted_as("Spread"), F.col("M_PKG_CURR_R"))


def spread_notation() -> Column:
    return _notation("Spread", SPREAD_NOTATION, None)
