"""Trade classifiers that need nothing but the trade row.

Conditions are three-valued: an unknown condition is not met and the next rule
is tried.  No rule may therefore be negated or merged under the assumption that
its operands are known.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tradescribe import constants as K
from tradescribe.functions.dates import months_between
from tradescribe.functions.rules import any_of, first_match, lookup
from tradescribe.functions.text import folded, last_char, mentions, trimmed
from tradescribe.operators.deals import bought, deal, family, group, product, sold

# Settlement codes and the delivery types they stand for.
CFI_DELIVERY = {"C": "CASH", "P": "PHYS", "E": "OPTL"}
SETTLEMENT_DELIVERY = {"C": "CASH", "D": "PHYS"}
EQUITY_DELIVERY = {"C": "CASH", "D": "PHYS", "Z": "OPTL"}
CREDIT_DELIVERY = {"Cash": "CASH", "Delivery": "PHYS", "Cash or delivery": "OPTL", "Auction": "OPTL"}


def delivery_type(*, padded_codes_match: bool = True) -> Column:
    """Cash, physical or optional delivery.

    The source compares ``H_DVCS`` in two ways, one of which sees the blank
    padding of a fixed-width column.  Blanks are dropped on reading, so codes
    match; ``padded_codes_match=False`` gives the other reading, in which no
    padded code ever matches.
    """
    code = F.col("H_DVCS") if padded_codes_match else F.lit(None).cast("string")
    two_currencies = F.coalesce("C_CUR_PL", F.lit(" ")) != F.coalesce("TP_RTCUR0", F.lit(" "))
    rates = first_match(
        [
            (product("IRD_OSWP"), lookup(code, SETTLEMENT_DELIVERY)),
            (~product("IRD_FRA", "IRD_TRS") & two_currencies, "CASH"),
        ],
        otherwise="PHYS",
    )
    equity = F.when(group("EQUIT", "OPT"), lookup(code, EQUITY_DELIVERY))
    bond_return = mentions(F.col("M_TP_MSTRUCT"), "BRS")
    credit = first_match(
        [(group("RTRN", "TRS"), F.when(bond_return, F.lit(None)).otherwise("CASH"))],
        otherwise=lookup(F.col("M_TP_CRISDA"), CREDIT_DELIVERY),
    )
    by_family = first_match(
        [
            (family("CURR"), lookup(code, SETTLEMENT_DELIVERY)),
            (family("IRD"), rates),
            (family("EQD") | product("IRD_RTRN_BSK"), equity),
            (family("CRD"), credit),
        ]
    )
    return F.coalesce(lookup(last_char(trimmed(F.col("M_CFI"))), CFI_DELIVERY), by_family)


def package_indicator() -> Column:
    """Whether the trade is part of a package."""
    package_log = trimmed(F.col("H_PKG_LOG_ID"))
    package_class = F.col("PKG_CLASS")
    return first_match(
        [
            (product("CURR_FXD_SWLEG"), "TRUE"),
            (product("CURR_FXD_FXD") & (F.col("M_BUSINE_EVT") == "Exercise"), "FALSE"),
            (package_class == "internal", "FALSE"),
            ((package_class == "single") & package_log.isNull(), "FALSE"),
            (F.col("CNT_TYPO").isin("Bespoke CDS", "INVSMT ALLOC METHD"), "FALSE"),
            ((F.col("PACKAGE") != 0) | package_log.isNotNull(), "TRUE"),
        ],
        otherwise="FALSE",
    )


def cleared() -> Column:
    """Cleared (Y), intended to be cleared (I) or not cleared (N)."""
    return first_match(
        [
            (F.col("M_CCP_NAME").isNull(), "N"),
            (folded(F.col("M_AUTO_CLR")).isin("Y", "TRUE"), "I"),
            (folded(F.col("M_CLEAR_STS")) == "REGISTERED", "Y"),
        ],
        otherwise="N",
    )


def can_clearable() -> Column:
    """Whether the trade is an overnight swap of at most ten years."""
    start = F.coalesce("H_UNADJST0", "H_DTETRN")
    end = F.coalesce("H_UNADJMAT", "H_DTELST")
    eligible = (
        (F.col("HS_UPI") == "InterestRate:IRSwap:OIS")
        & (F.col("M_SCHEDULE") == "C")
        & (months_between(end, start) / 12 <= K.CLEARABLE_YEARS)
    )
    return F.when(eligible, "Y").otherwise("N")


def embedded_option() -> Column:
    """Kind of option embedded in the trade, if any."""
    typology = F.upper("CNT_TYPO")
    untyped = trimmed(F.col("CNT_TYPO")).isNull()
    package_type = F.col("M_PKG_TYP_R")
    mutual_put = folded(F.col("HS_MUTUALP"))
    note = F.upper("M_HS_PCK_DSC")
    cancellable = (
        family("IRD", "EQD", "CRD")
        & (F.coalesce("TRN_GRP", F.lit(" ")) != "OSWP")
        & F.col("TP_CANCBY").isNotNull()
    )
    other_by_package = any_of(
        [
            product("IRD_IRS") & (package_type == "IR Rebate Swap") & untyped,
            package_type.isin("IR Floored Rate", "IR Capped Rate"),
            group("IRS") & (F.col("HS_UPI") == "InterestRate:Exotic") & trimmed(package_type).isNotNull(),
        ]
    )
    return first_match(
        [
            (mentions(typology, "CONTINGENT"), "MDET"),
            (folded(F.col("CNT_TYPO")) == "SUST LINK DERIV", "OTHR"),
            (mentions(typology, "CANC") | cancellable, "CANC"),
            (other_by_package, "OTHR"),
            (mutual_put == "MANDATORY", "MDET"),
            (mutual_put == "OPTIONAL", "OPET"),
            (mentions(note, "MET", "MANDATORY EARLY TERMINATION"), "MDET"),
            (mentions(note, "OET", "OPTIONAL EARLY TERMINATION"), "OPET"),
            (mentions(note, "EXTENDIBLE") | (folded(F.col("U_OPTTYPE")) == "EXTENDIBLE"), "EXTD"),
            (mentions(note, "OFFSETCLAUSE"), "OTHR"),
        ]
    )


def base_direction(lender: str = K.LENDING_DESK) -> Column:
    """Side of the reporting party: buyer or seller; ``lender`` sells swaps with a positive rate."""
    payment, rate = F.col("H_IPAY"), F.col("TP_RTCCP02")
    lends_at_rate = (F.col("TP_LENTDSP") == lender) & (rate > 0)
    receiving_leg = (F.col("DEAL_LEG") == 1) | (F.col("TP_RTNBLEG") == 1)
    return first_match(
        [
            (deal("IRD", "IRS"), F.when(lends_at_rate, "SLLR").otherwise("BYER")),
            ((payment < 0) | (rate < 0), "BYER"),
            ((payment > 0) | (rate > 0), "SLLR"),
            (receiving_leg, F.when(bought(), "SLLR").when(sold(), "BYER")),
            (bought(), "BYER"),
            (sold(), "SLLR"),
        ]
    )
