"""Fields that name a party of the trade.

They read the raw trade columns TRN_FMLY, TRN_GRP, HS_UPI, H_BS and H_DVCS and
the matched counterparty.  The case rules differ from field to field on
purpose; do not share a search between them.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tradescribe import constants as K
from tradescribe.functions.rules import any_of, first_match, lookup
from tradescribe.functions.text import empty_to_null, joined
from tradescribe.operators.deals import bought, deal, family, sold, upi_mentions, upi_mentions_folded

PARTY_INPUTS = ["TRN_FMLY", "TRN_GRP", "HS_UPI", "H_BS", "H_DVCS"]


def _counterparty_lei() -> Column:
    return F.col("CPTY_LEI")


def counterparty_or_name(own_lei: str) -> Column:
    """The counterparty's LEI, else our LEI with its name appended."""
    named = joined(F.lit(own_lei), F.col("CPTY_NAME"))
    return F.coalesce(empty_to_null(_counterparty_lei()), named)


def identifier_type() -> Column:
    """Which kind of identifier the counterparty field holds."""
    return first_match(
        [
            (_counterparty_lei().isNotNull(), lookup(F.col("CPTY_ID_SOURCE_PRIV_LAW_IDENT"), {"Y": "PLID"}, "LEID")),
            (F.col("CPTY_ID_SOURCE_NAT_PERS_IND") == "Y", "NPID"),
        ]
    )


def yes_flag(name: str) -> Column:
    """TRUE for Y, FALSE for anything else or nothing."""
    return F.when(F.col(name) == "Y", "TRUE").otherwise("FALSE")


def _forward_like() -> Column:
    """Trades reported by payer and receiver instead of buyer and seller."""
    threshold_met = (F.coalesce("CLEARING_THRESHOLD_EXEEDED", F.lit("N")) != "N") | (
        F.coalesce("CANADIAN_DERIVATIVE_STATUS", F.lit("N")) != "N"
    )
    return any_of(
        [
            deal("EQD", "EQS"),
            deal("IRD", "TRS", "RTRN"),
            deal("COM", "SWAP"),
            deal("EQD", "RTRN") & (sold() | ~threshold_met),
        ]
    )


def _two_sided() -> Column:
    """Trades that have a buyer and a seller."""
    return any_of(
        [
            family("EQD", "CRD", "COM"),
            upi_mentions("Credit", "Equity"),
            deal("IRD", "OSWP", "BOND", "CF"),
            deal("IRD", "IRS") & upi_mentions_folded("CREDIT"),
            family("CURR") & (F.col("TRN_GRP") != "FXD"),
        ]
    )


def buyer(own_lei: str = K.OWN_LEI) -> Column:
    we_buy = bought() & ((F.col("TRN_FMLY") != "IRD") | ~upi_mentions("Credit"))
    return first_match(
        [
            (_forward_like(), None),
            (_two_sided(), F.when(we_buy, own_lei).otherwise(_counterparty_lei())),
        ]
    )


def seller(own_lei: str = K.OWN_LEI) -> Column:
    we_sell = sold() | (family("IRD") & upi_mentions("Credit"))
    return first_match(
        [
            (_forward_like(), None),
            (_two_sided(), F.when(we_sell, own_lei).otherwise(_counterparty_lei())),
        ]
    )


def payer_leg_1(own_lei: str = K.OWN_LEI) -> Column:
    has_buyer = any_of(
        [
            deal("IRD", "OSWP", "BOND", "CF"),
            deal("IRD", "IRS") & upi_mentions_folded("CREDIT"),
            deal("IRD", "CS") & upi_mentions_folded("CREDIT", "EQUITY"),
            deal("EQD", "OPT"),
            family("CURR") & (F.col("TRN_GRP") != "FXD"),
        ]
    )
    has_payer = any_of(
        [
            family("CURR", "IRD"),
            deal("EQD", "EQS"),
            deal("EQD", "RTRN") & sold(),
            deal("COM", "SWAP"),
        ]
    )
    rate_or_commodity = (family("IRD") & (F.col("TRN_GRP") != "TRS")) | family("COM")
    forward = deal("CURR", "FXD")
    in_canada = F.col("CANADA") == "Y"
    not_fully_canadian = (F.col("CANADA") != "Y") | (F.col("CANADIAN_DERIVATIVE_STATUS") != "Y")
    they = counterparty_or_name(own_lei)
    return first_match(
        [
            (has_buyer, None),
            (has_payer & bought(), F.when((forward & in_canada) | rate_or_commodity, they).otherwise(own_lei)),
            (has_payer, F.when((forward & not_fully_canadian) | rate_or_commodity, own_lei).otherwise(they)),
        ]
    )


def _delivered(for_delivery: Column, otherwise: Column) -> Column:
    """Rates trades only; a trade of unknown family counts as one."""
    return first_match([(F.col("TRN_FMLY") != "IRD", None), (F.col("H_DVCS") == "D", for_delivery)], otherwise)


def payer_leg_2(own_lei: str = K.OWN_LEI) -> Column:
    return _delivered(_counterparty_lei(), F.lit(own_lei))


def receiver_leg_1(own_lei: str = K.OWN_LEI) -> Column:
    return _delivered(_counterparty_lei(), F.lit(own_lei))


def receiver_leg_2(own_lei: str = K.OWN_LEI) -> Column:
    return _delivered(F.lit(own_lei), _counterparty_lei())
