"""Call and put fields of currency options."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tradescribe.functions.rules import first_match
from tradescribe.operators.deals import deal, trade_type

# Option styles whose fields depend on the barrier or averaging.
PATH_DEPENDENT = ("ASN", "BAR", "BAR2")

# The offshore code of a currency and its official code.
OFFSHORE, OFFICIAL = "CNH", "CNY"


def official_currency(code: Column) -> Column:
    return F.when(code == OFFSHORE, OFFICIAL).otherwise(code)


def _is(name: str, code: str) -> Column:
    return F.col(name) == code


def call_side(of_call: Column, of_put: Column) -> Column:
    """The call leg's value: of a call its own side, of a put the other side."""
    barrier = F.col("TP_OBAR1")
    plain = ~F.coalesce("TRN_TYPE", F.lit(" ")).isin(*PATH_DEPENDENT)
    settled = (_is("H_DVCS", "D") & (barrier != 0)) | (_is("H_DVCS", "C") & (barrier == 0))
    by_kind = first_match(
        [(_is("H_PUTCALL", "C"), of_call), (_is("H_PUTCALL", "P") & (plain | settled), of_put)]
    )
    return F.when(deal("CURR", "OPT"), by_kind)


def put_side(of_put: Column, of_call: Column) -> Column:
    """The put leg's value: of a put its own side, of a call the other side."""
    exercise = F.col("H_TP_AE")
    crossed = (_is("H_DVCS", "D") & (exercise == "E")) | (_is("H_DVCS", "C") & (exercise == "D"))
    reported = exercise.isin("D", "E") & (trade_type("SMP") | (trade_type(*PATH_DEPENDENT) & crossed))
    by_kind = first_match([(_is("H_PUTCALL", "P"), of_put), (_is("H_PUTCALL", "C"), of_call)])
    return F.when(deal("CURR", "OPT") & reported, by_kind)


def call_value() -> Column:
    return call_side(F.col("TP_IQTY"), F.col("TP_QTYEQ"))


def put_value() -> Column:
    return put_side(F.col("TP_IQTY"), F.col("TP_QTYEQ"))


def call_currency() -> Column:
    return call_side(official_currency(F.col("TP_FXSTNUM")), official_currency(F.col("TP_FXSTDEN")))


def put_currency() -> Column:
    return put_side(official_currency(F.col("TP_FXSTNUM")), official_currency(F.col("TP_FXSTDEN")))
