"""The trade report: one row of 43 fields per trade.

Shape of the plan
-----------------
1. Everything that only the trade row decides is computed in the scan stage.
   What travels on are short results and a few raw codes, not 60 raw columns.
2. One join adds the counterparty, resolved per distinct code combination.
3. One join adds the schedule, resolved per (trade, date).
4. Party fields follow from 2; constant fields are added last and never travel.

Both joins are left joins with a side known to be unique, so a query that uses
only some report columns drops the joins, and the tables, it does not need.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tradescribe import constants as K
from tradescribe.functions.numbers import amount_text
from tradescribe.functions.text import chained_packs, first_packs, last_packs, packed, with_unpacked
from tradescribe.operators import classify, clearing, events, options, packages, parties, units
from tradescribe.operators.counterparty import attach_match, match_table, with_match_keys
from tradescribe.operators.schedule import TRADE_KEY, schedules, with_day
from tradescribe.operators.trades import base_trades, on_list, on_list_late
from tradescribe.sources.layout import in_parts_of, on_dates
from tradescribe.sources.schemas import REPORT_COLUMNS, TEXT
from tradescribe.sources.tables import normal_fixflows


def classified(trades: DataFrame) -> DataFrame:
    """Trades plus the values that other fields read, some of them many times."""
    return trades.withColumns(
        {
            "CLEARED": classify.cleared(),
            "CAN_CLEARABLE": classify.can_clearable(),
            "EMBEDDED_OPTION": classify.embedded_option(),
            "PACKAGE_INDICATOR": classify.package_indicator(),
            "CALL_VALUE": options.call_value(),
            "PUT_VALUE": options.put_value(),
            "CALL_CURR_LEG_1": options.call_currency(),
            "PUT_CURR_LEG_1": options.put_currency(),
        }
    )


def trade_fields() -> dict[str, Column]:
    """Report fields, and the exception route, that the trade row decides."""
    return {
        "CLEARED": F.col("CLEARED"),
        "CAN_CLEARABLE": F.col("CAN_CLEARABLE"),
        "HS_MAT_LAB": F.col("HS_MAT_LAB"),
        "EXCEPTION_ROUTE": clearing.exception_route(),
        "BASKET_INDICATOR": parties.yes_flag("M_BASKET_IND"),
        "EVENT_IDENTIFIER": events.event_identifier(),
        "EVENT_TIMESTAMP": events.event_timestamp(),
        "CALL_VALUE": F.col("CALL_VALUE"),
        "CALL_CURR_LEG_1": F.col("CALL_CURR_LEG_1"),
        "PUT_VALUE": F.col("PUT_VALUE"),
        "PUT_CURR_LEG_1": F.col("PUT_CURR_LEG_1"),
        "QUANTITY_UNIT_MEASURE_LEG_1": units.unit_leg_1(),
        "QUANTITY_UNIT_MEASURE_LEG_2": units.unit_leg_2(),
        "PACKAGE_INDICATOR": F.col("PACKAGE_INDICATOR"),
        "PACKAGE_ID": packages.package_id(),
        "PACKAGE_TRAN_PRICE": packages.price(),
        "PACKAGE_TRAN_PRICE_CURR": packages.price_currency(),
        "PACKAGE_TRAN_PRICE_NOTAT": packages.price_notation(),
        "PACKAGE_TRAN_SPREAD": packages.spread(),
        "PACKAGE_TRAN_SPREAD_CURR": packages.spread_currency(),
        "PACKAGE_TRAN_SPREAD_NOTAT": packages.spread_notation(),
    }


def party_fields(own_lei: str = K.OWN_LEI) -> dict[str, Column]:
    """Report fields that the matched counterparty takes part in."""
    return {
        "CLEARING_CPTY_2": clearing.clearing_exception(F.col("EXCEPTION_ROUTE")),
        "COUNTERPARTY_2": parties.counterparty_or_name(own_lei),
        "PARTY_TYP2": parties.identifier_type(),
        "FINANCIAL_ENTITY_2": parties.yes_flag("FINANCIAL_ENTITY"),
        "BUYER_IDENTIFIER": parties.buyer(own_lei),
        "SELLER_IDENTIFIER": parties.seller(own_lei),
        "PAYER_IDENTIFIER_LEG_1": parties.payer_leg_1(own_lei),
        "PAYER_IDENTIFIER_LEG_2": parties.payer_leg_2(own_lei),
        "RECEIVER_IDENTIFIER_LEG_1": parties.receiver_leg_1(own_lei),
        "RECEIVER_IDENTIFIER_LEG_2": parties.receiver_leg_2(own_lei),
        "CPTY_2_FE_INDICATOR": parties.yes_flag("FED_ENTITY_INDICATOR"),
    }


def amount_fields() -> dict[str, Column]:
    """The amounts' wide texts, which do not travel either."""
    return {
        "CALL_AMOUNT_LEG_1": amount_text(F.col("CALL_VALUE")),
        "PUT_AMOUNT_LEG_1": amount_text(F.col("PUT_VALUE")),
    }


def constant_fields(own_lei: str = K.OWN_LEI) -> dict[str, Column]:
    """Report fields that never vary."""
    empty = F.lit(None).cast("string")
    return {
        "COUNTERPARTY_1": F.lit(own_lei),
        "FINANCIAL_ENTITY_1": F.lit("TRUE"),
        "CALL_AMOUNT_LEG_2": empty,
        "CALL_CURR_LEG_2": empty,
        "PUT_AMOUNT_LEG_2": empty,
        "PUT_CURR_LEG_2": empty,
    }


# What the party fields read of a trade.
_ROUTED_INPUTS = [*parties.PARTY_INPUTS, "EXCEPTION_ROUTE"]

# The texts that travel, in one, where a report is compact.
PACK = "TEXTS_"


def _plain_texts(rows: DataFrame, early: dict[str, Column]) -> list[str]:
    """Early fields that travel as texts and that no party field reads."""
    return [f.name for f in rows.schema if f.dataType == TEXT and f.name in early and f.name not in _ROUTED_INPUTS]


def report(
    trades: DataFrame,
    counterparties: DataFrame,
    fixflows: DataFrame,
    *,
    as_of: date | DataFrame | None = None,
    allow_list: DataFrame | None = None,
    own_lei: str = K.OWN_LEI,
    list_cap: int = K.LIST_CAP,
    by_trade: bool = False,
    compact: bool = False,
) -> DataFrame:
    """Report on ``trades``; any DataFrame with the trade columns will do.

    ``as_of`` and ``allow_list`` restrict the trades (see ``base_trades``).
    All lookups share the trade's value date, so ``as_of`` restricts the other
    two tables to the same dates; the list restricts the flows as well.
    ``by_trade`` says that the flows lie in buckets of trade numbers (see
    ``write_by_trade``) and are joined there.  ``compact`` is for reports of
    which most fields are used: the trades' texts travel packed, which halves
    what they shuffle, but a query that uses a few fields computes all of them.

    Notional lists longer than ``list_cap`` bytes are cut after a whole element
    and end in an ellipsis.
    """
    counterparties = on_dates(counterparties, "RPY_VALUE_DATE", as_of)
    fixflows = in_parts_of(on_dates(fixflows, "FFL_VALUE_DATE", as_of), allow_list)
    base = base_trades(trades, as_of=as_of, allow_list=allow_list)
    flows = on_list(normal_fixflows(fixflows), allow_list)
    early = trade_fields()
    keys = [*TRADE_KEY, "THD_VALUE_DATE", "PRIMARY_CODE", "FALLBACK_CODE"]
    unlisted = base_trades(in_parts_of(trades, allow_list), as_of=as_of)
    short = with_day(with_match_keys(classified(unlisted))).select(
        *keys, *parties.PARTY_INPUTS, *[value.alias(name) for name, value in early.items()]
    )
    late = party_fields(own_lei)
    matches = match_table(base, counterparties)
    found = schedules(base, flows, cap=list_cap, by_trade=by_trade)
    if compact and own_lei:  # an empty text is NULL in a pack
        texts = _plain_texts(short, early)
        kept = [name for name in early if name not in [*texts, *_ROUTED_INPUTS]]
        pack = packed(*map(F.col, [*_ROUTED_INPUTS, *texts])).alias(PACK)
        travelling = on_list_late(short.select(*keys, *kept, pack).drop("DAY"), allow_list)
        inputs, rest = first_packs(F.col(PACK), len(_ROUTED_INPUTS)), last_packs(F.col(PACK), len(texts))
        opened = with_day(attach_match(travelling, matches)).withColumns({PACK: rest, "INPUTS_": inputs})
        with_parties = with_unpacked(opened, "INPUTS_", _ROUTED_INPUTS).select(
            *TRADE_KEY, *kept, PACK, *[value.alias(name) for name, value in late.items()]
        )
        pack = chained_packs(packed(*map(F.col, late)), F.col(PACK)).alias(PACK)
        scheduled = with_parties.select(*TRADE_KEY, *kept, pack).join(found, TRADE_KEY, "left")
        scheduled = with_unpacked(scheduled, PACK, [*late, *texts])
    else:
        with_parties = attach_match(on_list_late(short, allow_list), matches).select(
            *TRADE_KEY, *early, *[value.alias(name) for name, value in late.items()]
        )
        scheduled = with_parties.join(found, TRADE_KEY, "left")
    complete = scheduled.withColumns(
        {
            **amount_fields(),
            **constant_fields(own_lei),
            "NOTI_AMOUNT_IE_ON_ASSOC_EFF_DATE_LEG_1": F.col("CONCAT_CAPREM0"),
        }
    )
    return complete.select(*REPORT_COLUMNS)


def publish(
    trades: DataFrame, counterparties: DataFrame, fixflows: DataFrame, name: str = "trade_report", **options
) -> DataFrame:
    """Publish the report as a SQL view and return it; options as for ``report``."""
    result = report(trades, counterparties, fixflows, **options)
    result.createOrReplaceTempView(name)
    return result
