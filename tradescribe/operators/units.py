"""Unit of measure of each leg, from the UPI path."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tradescribe.functions.rules import first_match
from tradescribe.functions.text import mentions

# UPI path prefixes and their units.  Leg 1 compares as written,
# leg 2 in upper case; the agricultural entries differ.
CURRENCY_UNITS = {"ForeignExchange:": "ACCY", "InterestRate:": "ACCY", "Credit:": "ACCY"}
COMMODITY_UNITS = {
    "Commodity:Energy:Oil:": "BARL",
    "Commodity:Energy:NatGas:": "MBTU",
    "Commodity:Energy:Elec:": "MWHO",
    "Commodity:Metals:Precious:": "OZTR",
    "Commodity:Metals:NonPrecious:": "KILO",
}
LEG_1_AGRICULTURE = {"Commodity:Agricultural:": "BUSL"}
LEG_2_AGRICULTURE = {"Commodity:Agricultural:GrainsOilseeds:": "BUSL"}


def unit_leg_1() -> Column:
    upi = F.col("HS_UPI")
    units = CURRENCY_UNITS | COMMODITY_UNITS | LEG_1_AGRICULTURE
    equity = F.when(mentions(upi, "Index", "Basket"), "IPNT").otherwise("SHAS")
    return first_match(
        [(upi.startswith("Equity:"), equity), *[(upi.startswith(path), unit) for path, unit in units.items()]],
        otherwise="OTHR",
    )


def unit_leg_2() -> Column:
    upi = F.upper("HS_UPI")
    units = CURRENCY_UNITS | COMMODITY_UNITS | LEG_2_AGRICULTURE
    plain_option = mentions(upi, "OPTION") & (F.coalesce("TRN_TYPE", F.lit(" ")) != "SWAP")
    return first_match(
        [
            (upi.isNull() | plain_option | upi.startswith("EQUITY:"), None),
            *[(upi.startswith(path.upper()), unit) for path, unit in units.items()],
        ],
        otherwise="OTHR",
    )
