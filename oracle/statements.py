"""One complete DuckDB statement per registered query."""

from __future__ import annotations

from oracle import rules as R, tables as D
from tradescribe.sources.schemas import (
    COUNTERPARTIES,
    EXTRACT_COLUMNS,
    FIXFLOWS,
    REPORT_COLUMNS,
    TRADES,
)

TABLES = [D.TRADES, D.COUNTERPARTIES, D.FIXFLOWS]
RULES = [R.BASE, R.COUNTERPARTY, R.CLASSES, R.schedule(), R.FIELDS, R.REPORT]


def statement(select: str, *ctes: str) -> str:
    return f"WITH {', '.join(cte.strip() for cte in ctes)}\n{select}"


def _on_tables(select: str) -> str:
    return statement(select, *TABLES, *RULES)


def _reported(*columns: str) -> str:
    return _on_tables(f"SELECT {', '.join(columns)} FROM reported")


def _shown(schema) -> str:
    """Columns of a schema, decimals as plain text."""
    return ", ".join(
        f"{R.plain_number(f.name)} AS {f.name}" if f.dataType.typeName() == "decimal" else f.name for f in schema
    )


_PADDED = "'  ' || left(o_orderpriority, o_orderkey % 4) || ' '"
_PRICE = "o_totalprice::DECIMAL(20,2)::DECIMAL(38,12)"
_SIGNED = f"({_PRICE} - 250000.005::DECIMAL(20,3))"
_PART = "CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END"
_DAY = "l_shipdate::DATE"
_ATTRIBUTES = [R.CARRIED.get(name, name) for name in R.ATTRIBUTES]

# Every trade on two value dates.
_TWO_DATES = [
    D.TRADES.replace("raw_trades AS", "first_trades AS"),
    """raw_trades AS (
      SELECT * FROM first_trades UNION ALL
      SELECT * REPLACE ((THD_VALUE_DATE + INTERVAL 1 MONTH)::DATE AS THD_VALUE_DATE) FROM first_trades)""",
]

# The trades are restricted, not the finished report: a list spans the dates of the trades it is made for.
_ON_THE_DAY = "raw_trades AS (SELECT * FROM all_trades WHERE THD_VALUE_DATE = DATE '1997-05-01')"
_AS_OF = [D.TRADES.replace("raw_trades AS", "all_trades AS"), _ON_THE_DAY]
_AS_OF_TWO_DATES = [
    _TWO_DATES[0], _TWO_DATES[1].replace("raw_trades AS", "all_trades AS"), _ON_THE_DAY
]

_ON_THE_DAYS = """raw_trades AS (
  SELECT * FROM all_trades WHERE THD_VALUE_DATE IN (
    SELECT date_trunc('month', o_orderdate)::DATE FROM orders
    WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 480000))"""

# The extract shows the padded code as the source has it.
_RAW_BASE = R.BASE.replace("FROM raw_trades", ", H_DVCS AS SOURCE_DVCS FROM raw_trades")
_RAW_EXTRACT = ", ".join("SOURCE_DVCS AS H_DVCS" if name == "H_DVCS" else name for name in EXTRACT_COLUMNS)

STATEMENTS = {
    "trades_base": _on_tables(f"SELECT {_shown(TRADES)} FROM t"),
    "flows_base": _on_tables(f"SELECT {_shown(FIXFLOWS)} FROM f"),
    "dialect_functions": f"""
SELECT o_orderkey,
  nullif(trim({_PADDED}, ' '), '') AS trimmed,
  upper(nullif(trim({_PADDED}, ' '), '')) AS folded,
  nullif(right(trim({_PADDED}, ' '), 1), '') AS last_char,
  o_orderstatus || ifnull({_PART}, '') AS joined,
  CASE {_PART} WHEN '1-URGENT' THEN 'U' WHEN '5-LOW' THEN 'L' ELSE 'other' END AS looked_up,
  {R.plain_number(_PRICE)} AS price_text,
  {R.plain_number(_SIGNED)} AS signed_text,
  {R.plain_number('((o_orderkey % 400) * 0.0025::DECIMAL(5,4))::DECIMAL(38,12)')} AS ratio_text,
  {R.wide_amount(_PRICE)} AS price_amount,
  {R.wide_amount(_SIGNED)} AS signed_amount,
  o_orderkey AS number
FROM orders""",
    "add_months_horizon": f"""
SELECT l_orderkey, l_linenumber, {_DAY} AS day,
  {', '.join(f'{R.later_by_months(_DAY, n)} AS plus_{n}' for n in (1, 12, 60))}
FROM lineitem""",
    "months_between_tenor": f"""
WITH d AS (
  SELECT l_orderkey, l_linenumber, l_shipdate::DATE AS late, o_orderdate::DATE AS early
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
apart AS (SELECT *, {R.months_apart('late', 'early')} AS m FROM d)
SELECT l_orderkey, l_linenumber, {R.plain_number('m::DECIMAL(18,8)')} AS months, round(m)::INTEGER AS whole_months,
  (late - early)::INTEGER AS days
FROM apart""",
    "relevant_keys": _on_tables("SELECT d AS RPY_VALUE_DATE, code AS MUREX_COUNTERPART FROM wanted"),
    "counterparty_relevant": _on_tables(f"SELECT {', '.join(f.name for f in COUNTERPARTIES)} FROM relevant"),
    "counterparty_latest": _on_tables(
        f"SELECT MUREX_COUNTERPART, RPY_VALUE_DATE, {', '.join(R.ATTRIBUTES)} FROM newest"
    ),
    "counterparty_snapshot": _on_tables(
        f"SELECT MUREX_COUNTERPART, RPY_VALUE_DATE, {', '.join(R.ATTRIBUTES)} FROM newest"
    ),
    "counterparty_match": _on_tables(
        f"SELECT NB, THD_VALUE_DATE, {', '.join(_ATTRIBUTES)}, MATCH_PRIORITY, MATCH_SOURCE FROM m"
    ),
    "buyer_by_nb": _on_tables("SELECT NB, BUYER_IDENTIFIER FROM fields ORDER BY NB::BIGINT"),
    "payer_by_nb": _on_tables("SELECT NB, PAYER_IDENTIFIER_LEG_1 FROM fields ORDER BY NB::BIGINT"),
    "seller_identifier": _reported("NB", "SELLER_IDENTIFIER"),
    "counterparty_ids": _reported(
        "NB", "COUNTERPARTY_1", "COUNTERPARTY_2", "PARTY_TYP2", "FINANCIAL_ENTITY_1", "FINANCIAL_ENTITY_2"
    ),
    **{
        name.lower(): _on_tables(f"SELECT NB, {name} FROM k")
        for name in (
            "DELIVERY_TYPE",
            "PACKAGE_INDICATOR",
            "CLEARED",
            "CAN_CLEARABLE",
            "EMBEDDED_OPTION",
            "BASE_DIRECTION",
        )
    },
    "notionals": _on_tables("SELECT NB, CONCAT_CAPREM0 FROM notional"),
    "notionals_truncated": statement("SELECT NB, CONCAT_CAPREM0 FROM notional", *TABLES, R.BASE, R.schedule(20)),
    "next_schedule_date": _on_tables("SELECT NB, THD_VALUE_DATE, DT_LEG0, LEGSTEP, DATE2, NEXT_DATE2 FROM steps"),
    "frequency_legs": _on_tables("SELECT * FROM frequency"),
    "frequency_with_time": statement(
        "SELECT * FROM frequency",
        D.TRADES,
        D.COUNTERPARTIES,
        D.FIXFLOWS.replace("raw_fixflows AS", "dated_fixflows AS"),
        "raw_fixflows AS (SELECT * REPLACE (DATE2::TIMESTAMP + to_hours((LEGSTEP * 7 + DT_LEG0 * 5) % 24) AS DATE2)"
        " FROM dated_fixflows)",
        R.BASE,
        R.schedule(timed=True),
    ),
    "clearing_exception": _reported("NB", "CLEARED", "CAN_CLEARABLE", "CLEARING_CPTY_2"),
    "payer_receiver_legs": _reported(
        "NB",
        "PAYER_IDENTIFIER_LEG_1",
        "PAYER_IDENTIFIER_LEG_2",
        "RECEIVER_IDENTIFIER_LEG_1",
        "RECEIVER_IDENTIFIER_LEG_2",
    ),
    "option_amounts": _reported(
        "NB", "CALL_AMOUNT_LEG_1", "CALL_AMOUNT_LEG_2", "PUT_AMOUNT_LEG_1", "PUT_AMOUNT_LEG_2"
    ),
    "option_currencies": _reported("NB", "CALL_CURR_LEG_1", "CALL_CURR_LEG_2", "PUT_CURR_LEG_1", "PUT_CURR_LEG_2"),
    "quantity_units": _reported("NB", "QUANTITY_UNIT_MEASURE_LEG_1", "QUANTITY_UNIT_MEASURE_LEG_2"),
    "package_fields": _reported("NB", *[c for c in REPORT_COLUMNS if c.startswith("PACKAGE_")]),
    "event_fields": _reported("NB", "EVENT_IDENTIFIER", "EVENT_TIMESTAMP", "HS_MAT_LAB"),
    "fixed_fields": _reported("NB", "COUNTERPARTY_1", "FINANCIAL_ENTITY_1", "CPTY_2_FE_INDICATOR", "BASKET_INDICATOR"),
    "schedule_fields": _reported(
        "NB",
        "NOTI_AMOUNT_IE_ON_ASSOC_EFF_DATE_LEG_1",
        "QTY_FREQUENCY_LEG_1",
        "QTY_FREQUENCY_LEG_2",
        "QTY_FREQ_MULT_LEG_1",
        "QTY_FREQ_MULT_LEG_2",
    ),
    "report_view": _on_tables(
        "SELECT CLEARED, CAN_CLEARABLE, CLEARING_CPTY_2, count(*) AS TRADES FROM reported "
        "GROUP BY CLEARED, CAN_CLEARABLE, CLEARING_CPTY_2"
    ),
    "report_full": _reported(*REPORT_COLUMNS),
    "report_as_of": statement(
        f"SELECT {', '.join(REPORT_COLUMNS)} FROM reported", *_AS_OF, D.COUNTERPARTIES, D.FIXFLOWS, *RULES
    ),
    "report_as_of_dates": statement(
        f"SELECT {', '.join(REPORT_COLUMNS)} FROM reported", _AS_OF[0], _ON_THE_DAYS, D.COUNTERPARTIES, D.FIXFLOWS, *RULES
    ),
    "report_as_of_alternate_base": statement(
        f"SELECT {', '.join(REPORT_COLUMNS)} FROM reported", *_AS_OF_TWO_DATES, D.COUNTERPARTIES, D.FIXFLOWS, *RULES
    ),
    "report_allow_list": statement(
        f"SELECT {', '.join(REPORT_COLUMNS)} FROM reported WHERE NB IN (SELECT NB FROM returned)",
        D.RETURNED,
        *TABLES,
        *RULES,
    ),
    "report_alternate_base": statement(
        f"SELECT {', '.join(REPORT_COLUMNS)} FROM reported",
        *_TWO_DATES,
        D.COUNTERPARTIES,
        D.FIXFLOWS,
        *RULES,
    ),
    "payer_extract": statement(
        f"SELECT {_RAW_EXTRACT} FROM m WHERE NB IN (SELECT NB FROM returned)", D.RETURNED, *TABLES, _RAW_BASE, R.COUNTERPARTY
    ),
    "payer_extract_csv": statement(
        f"SELECT {', '.join(f'nullif({name}, {chr(39) * 2}) AS {name}' for name in EXTRACT_COLUMNS)}"
        f" FROM (SELECT {_RAW_EXTRACT} FROM m WHERE NB IN (SELECT NB FROM returned))",
        D.RETURNED,
        *TABLES,
        _RAW_BASE,
        R.COUNTERPARTY,
    ),
    "payer_extract_as_of": statement(
        f"SELECT {_RAW_EXTRACT} FROM m WHERE NB IN (SELECT NB FROM returned)",
        D.RETURNED,
        *_AS_OF_TWO_DATES,
        D.COUNTERPARTIES,
        D.FIXFLOWS,
        _RAW_BASE,
        R.COUNTERPARTY,
    ),
}
