"""Clearing exception of the counterparty."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tradescribe.functions.rules import any_of, first_match
from tradescribe.functions.text import folded
from tradescribe.operators.deals import family, group

# Exemption flags by precedence, and the codes they report.
EXEMPTIONS = {
    "CLR_EX_END_USER_EXCEPTION": "ENDU",
    "CLR_EX_SMALL_BK_EXEMPTION": "SMBK",
    "CLR_EX_COOP_EXEMPTION": "COOP",
    "CLR_EX_NO_ACT_LETTER": "NOAL",
    "CLR_EX_OTHER_EXCEPTIONS": "OTHR",
}

_AFFILIATE, _BY_FLAG, _ANY_FLAG = "AFFL", "by flag", "any flag"


def exception_route() -> Column:
    """How the exception is decided, as far as the trade row tells.

    Reads the classifiers CLEARED, CAN_CLEARABLE and EMBEDDED_OPTION.  One short
    code then travels to the counterparty join in place of eight columns.
    """
    out_of_scope = any_of(
        [
            F.col("CLEARED").isin("Y", "I"),
            F.col("EMBEDDED_OPTION").isNotNull(),
            family("CURR", "COM", "EQD"),
            group("BOND", "CF", "TRS", "RTRN", "CDS"),
        ]
    )
    canadian = (F.col("HS_REPROLCSA") == "Y") & (F.col("CAN_CLEARABLE") == "Y")
    american = F.coalesce("HS_REPROLCFTC", F.lit(" ")) == "Y"
    affiliate = folded(F.col("M_MARGIN_IND")) == "AFFILIATE"
    return first_match(
        [
            (out_of_scope, None),
            (canadian & affiliate, _AFFILIATE),
            (canadian & american, _BY_FLAG),
            (canadian, _ANY_FLAG),
        ]
    )


def clearing_exception(route: Column) -> Column:
    """Exception code, from the route and the counterparty's exemption flags.

    A trade reported in both countries names its first exemption; one reported
    in Canada only says no more than that there is one.
    """
    flags = [(F.col(name) == "Y", code) for name, code in EXEMPTIONS.items()]
    exempt = any_of([condition for condition, _ in flags])
    return first_match(
        [
            (route == _AFFILIATE, _AFFILIATE),
            (route == _BY_FLAG, first_match(flags)),
            ((route == _ANY_FLAG) & exempt, "OTHR"),
        ]
    )
