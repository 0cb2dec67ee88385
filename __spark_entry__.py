"""Entry points: flagship query, all queries, and their expected results in DuckDB."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# The packages lie next to this file, wherever it is loaded from.
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle.statements import STATEMENTS
from tradescribe.functions.dates import add_months, days_between, months_between
from tradescribe.functions.numbers import amount_text, number_text, text_number
from tradescribe.functions.rules import lookup
from tradescribe.functions.text import folded, joined, last_char, trimmed
from tradescribe.operators import classify
from tradescribe.operators.counterparty import (
    MATCH_COLUMNS,
    latest_versions,
    matched_trades,
    relevant_counterparties,
    relevant_keys,
)
from tradescribe.operators.snapshots import updated_snapshot, version_snapshot
from tradescribe.operators.schedule import frequencies, next_schedule_dates, notionals
from tradescribe.operators.trades import base_trades
from tradescribe.plans.consumer import field_list
from tradescribe.plans.investigate import investigation_extract
from tradescribe.plans.report import publish, report
from tradescribe.session import tune
from tradescribe.sources import driver_tables as tables
from tradescribe.sources.extract_csv import accepted, checked_extract, write_extract
from tradescribe.sources.layout import scratch_path
from tradescribe.sources.tables import normal_fixflows

try:
    import corpus_pipeline
    from tradescribe.llm.queries import QUERIES, STATEMENTS as LLM_STATEMENTS

    LLM_QUERIES = QUERIES | {"pipeline": corpus_pipeline.run}
except ModuleNotFoundError as missing:  # the training-data operators can be left out
    if missing.name not in ("tradescribe.llm", "tradescribe.llm.queries", "corpus_pipeline"):
        raise
    LLM_QUERIES, LLM_STATEMENTS = {}, {}

SMOKE_DIR = "/root/testdata/sf0.001"

Query = Callable[[SparkSession, str], DataFrame]


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    tune(spark)
    return (
        tables.trades(spark, sf_dir),
        tables.counterparties(spark, sf_dir),
        tables.fixflows(spark, sf_dir),
    )


def _decimals_as_text(df: DataFrame) -> DataFrame:
    """Decimals in plain text, which compares equal across engines."""
    return df.select(
        *[
            number_text(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema
        ]
    )


def _report_fields(*fields: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(*_inputs(spark, sf_dir)).select("NB", *fields)

    return run


def _sorted_field(field: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return field_list(*_inputs(spark, sf_dir), field)

    return run


def _classifier(name: str, rule: Callable) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        trades, _, _ = _inputs(spark, sf_dir)
        return base_trades(trades).select("NB", rule().alias(name))

    return run


def _trades_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades, _, _ = _inputs(spark, sf_dir)
    return _decimals_as_text(base_trades(trades))


def _flows_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, fixflows = _inputs(spark, sf_dir)
    return _decimals_as_text(normal_fixflows(fixflows))


def _dialect_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tune(spark).read.parquet(f"{sf_dir}/orders.parquet")
    price = F.col("o_totalprice").cast("decimal(20,2)").cast("decimal(38,12)")
    signed = price - F.lit("250000.005").cast("decimal(20,3)")
    part = F.when(F.pmod("o_orderkey", F.lit(3)) > 0, F.col("o_orderpriority"))
    padded = F.concat(F.lit("  "), F.substring("o_orderpriority", 1, F.pmod("o_orderkey", F.lit(4)).cast("int")), F.lit(" "))
    return orders.select(
        "o_orderkey",
        trimmed(padded).alias("trimmed"),
        folded(padded).alias("folded"),
        last_char(trimmed(padded)).alias("last_char"),
        joined(F.col("o_orderstatus"), part).alias("joined"),
        lookup(part, {"1-URGENT": "U", "5-LOW": "L"}, "other").alias("looked_up"),
        number_text(price).alias("price_text"),
        number_text(signed).alias("signed_text"),
        number_text(F.pmod("o_orderkey", F.lit(400)).cast("decimal(38,12)") / 400).alias("ratio_text"),
        amount_text(price).alias("price_amount"),
        amount_text(signed).alias("signed_amount"),
        text_number(F.col("o_orderkey").cast("string")).cast("long").alias("number"),
    )


def _add_months_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tune(spark).read.parquet(f"{sf_dir}/lineitem.parquet")
    day = F.col("l_shipdate").cast("date")
    return lines.select(
        "l_orderkey", "l_linenumber", day.alias("day"), *[add_months(day, n).alias(f"plus_{n}") for n in (1, 12, 60)]
    )


def _months_between_tenor(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    start, end = F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")
    months = months_between(end, start)
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey",
        "l_linenumber",
        number_text(months.cast("decimal(38,12)")).alias("months"),
        F.round(months).cast("int").alias("whole_months"),
        days_between(end, start).alias("days"),
    )


def _relevant_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades, _, _ = _inputs(spark, sf_dir)
    return relevant_keys(base_trades(trades))


def _counterparty_relevant(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades, counterparties, _ = _inputs(spark, sf_dir)
    return relevant_counterparties(base_trades(trades), counterparties)


def _counterparty_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades, counterparties, _ = _inputs(spark, sf_dir)
    return latest_versions(relevant_counterparties(base_trades(trades), counterparties))


def _counterparty_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades, counterparties, _ = _inputs(spark, sf_dir)
    return matched_trades(base_trades(trades), counterparties).select("NB", "THD_VALUE_DATE", *MATCH_COLUMNS)


def _notionals(**options) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        trades, _, fixflows = _inputs(spark, sf_dir)
        return notionals(base_trades(trades), normal_fixflows(fixflows), **options)

    return run


def _next_schedule_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades, _, fixflows = _inputs(spark, sf_dir)
    return next_schedule_dates(base_trades(trades), normal_fixflows(fixflows))


def _frequency_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades, _, fixflows = _inputs(spark, sf_dir)
    return frequencies(base_trades(trades), normal_fixflows(fixflows))


def _frequency_with_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequencies where steps start at some hour of the day."""
    trades, _, fixflows = _inputs(spark, sf_dir)
    hours = F.expr("make_dt_interval(0, pmod(LEGSTEP * 7 + DT_LEG0 * 5, 24))")
    timed = fixflows.withColumn("DATE2", F.col("DATE2").cast("timestamp_ntz") + hours)
    return frequencies(base_trades(trades), normal_fixflows(timed))


def _report_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    publish(*_inputs(spark, sf_dir), name="trade_report")
    return spark.sql(
        "SELECT CLEARED, CAN_CLEARABLE, CLEARING_CPTY_2, count(*) AS TRADES "
        "FROM trade_report GROUP BY CLEARED, CAN_CLEARABLE, CLEARING_CPTY_2"
    )


def _report_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(*_inputs(spark, sf_dir), compact=True)


def _report_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(*_inputs(spark, sf_dir), as_of=date(1997, 5, 1), compact=True)


def _report_as_of_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months in which some urgent order was worth more than 480,000."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    chosen = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 480_000)
    dates = orders.where(chosen).select(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("day"))
    return report(*_inputs(spark, sf_dir), as_of=dates, compact=True)


def _returned(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines.where(F.col("l_returnflag") == "R").select("l_orderkey")


def _report_allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(*_inputs(spark, sf_dir), allow_list=_returned(spark, sf_dir), compact=True)


def _on_two_dates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Another trade table: every trade on two value dates."""
    trades, counterparties, fixflows = _inputs(spark, sf_dir)
    month_later = trades.withColumn("THD_VALUE_DATE", F.add_months("THD_VALUE_DATE", 1))
    return trades.unionAll(month_later), counterparties, fixflows


def _report_alternate_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(*_on_two_dates(spark, sf_dir), compact=True)


def _report_as_of_alternate_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(*_on_two_dates(spark, sf_dir), as_of=date(1997, 5, 1), compact=True)


def _payer_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades, counterparties, _ = _inputs(spark, sf_dir)
    return investigation_extract(trades, counterparties, _returned(spark, sf_dir))


def _payer_extract_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract written as CSV and read back with its lines checked."""
    path = scratch_path(spark, "payer-extract")
    write_extract(_payer_extract(spark, sf_dir), path)
    return accepted(checked_extract(spark, path))


def _counterparty_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest versions from a snapshot of the old ones and the versions that came since."""
    trades, counterparties, _ = _inputs(spark, sf_dir)
    relevant = relevant_counterparties(base_trades(trades), counterparties)
    came_since = F.coalesce(F.dayofmonth("SYS_CREAT_DTMS") > 10, F.lit(False))
    snapshot = version_snapshot(relevant.where(~came_since))
    return updated_snapshot(snapshot, relevant.where(came_since)).drop("SYS_CREAT_DTMS")


def _payer_extract_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades, counterparties, _ = _on_two_dates(spark, sf_dir)
    return investigation_extract(trades, counterparties, _returned(spark, sf_dir), as_of=date(1997, 5, 1))


def entry(spark: SparkSession) -> DataFrame:
    """The full trade report on the smallest test tables."""
    return _report_full(spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    return {
        "trades_base": _trades_base,
        "flows_base": _flows_base,
        "dialect_functions": _dialect_functions,
        "add_months_horizon": _add_months_horizon,
        "months_between_tenor": _months_between_tenor,
        "relevant_keys": _relevant_keys,
        "counterparty_relevant": _counterparty_relevant,
        "counterparty_latest": _counterparty_latest,
        "counterparty_snapshot": _counterparty_snapshot,
        "counterparty_match": _counterparty_match,
        "buyer_by_nb": _sorted_field("BUYER_IDENTIFIER"),
        "payer_by_nb": _sorted_field("PAYER_IDENTIFIER_LEG_1"),
        "seller_identifier": _report_fields("SELLER_IDENTIFIER"),
        "counterparty_ids": _report_fields(
            "COUNTERPARTY_1", "COUNTERPARTY_2", "PARTY_TYP2", "FINANCIAL_ENTITY_1", "FINANCIAL_ENTITY_2"
        ),
        "delivery_type": _classifier("DELIVERY_TYPE", classify.delivery_type),
        "package_indicator": _classifier("PACKAGE_INDICATOR", classify.package_indicator),
        "cleared": _classifier("CLEARED", classify.cleared),
        "can_clearable": _classifier("CAN_CLEARABLE", classify.can_clearable),
        "embedded_option": _classifier("EMBEDDED_OPTION", classify.embedded_option),
        "base_direction": _classifier("BASE_DIRECTION", classify.base_direction),
        "notionals": _notionals(),
        "notionals_truncated": _notionals(cap=20),
        "next_schedule_date": _next_schedule_date,
        "frequency_legs": _frequency_legs,
        "frequency_with_time": _frequency_with_time,
        "clearing_exception": _report_fields("CLEARED", "CAN_CLEARABLE", "CLEARING_CPTY_2"),
        "payer_receiver_legs": _report_fields(
            "PAYER_IDENTIFIER_LEG_1",
            "PAYER_IDENTIFIER_LEG_2",
            "RECEIVER_IDENTIFIER_LEG_1",
            "RECEIVER_IDENTIFIER_LEG_2",
        ),
        "option_amounts": _report_fields(
            "CALL_AMOUNT_LEG_1", "CALL_AMOUNT_LEG_2", "PUT_AMOUNT_LEG_1", "PUT_AMOUNT_LEG_2"
        ),
        "option_currencies": _report_fields(
            "CALL_CURR_LEG_1", "CALL_CURR_LEG_2", "PUT_CURR_LEG_1", "PUT_CURR_LEG_2"
        ),
        "quantity_units": _report_fields("QUANTITY_UNIT_MEASURE_LEG_1", "QUANTITY_UNIT_MEASURE_LEG_2"),
        "package_fields": _report_fields(
            "PACKAGE_INDICATOR",
            "PACKAGE_ID",
            "PACKAGE_TRAN_PRICE",
            "PACKAGE_TRAN_PRICE_CURR",
            "PACKAGE_TRAN_PRICE_NOTAT",
            "PACKAGE_TRAN_SPREAD",
            "PACKAGE_TRAN_SPREAD_CURR",
            "PACKAGE_TRAN_SPREAD_NOTAT",
        ),
        "event_fields": _report_fields("EVENT_IDENTIFIER", "EVENT_TIMESTAMP", "HS_MAT_LAB"),
        "fixed_fields": _report_fields("COUNTERPARTY_1", "FINANCIAL_ENTITY_1", "CPTY_2_FE_INDICATOR", "BASKET_INDICATOR"),
        "schedule_fields": _report_fields(
            "NOTI_AMOUNT_IE_ON_ASSOC_EFF_DATE_LEG_1",
            "QTY_FREQUENCY_LEG_1",
            "QTY_FREQUENCY_LEG_2",
            "QTY_FREQ_MULT_LEG_1",
            "QTY_FREQ_MULT_LEG_2",
        ),
        "report_view": _report_view,
        "report_full": _report_full,
        "report_as_of": _report_as_of,
        "report_as_of_dates": _report_as_of_dates,
        "report_as_of_alternate_base": _report_as_of_alternate_base,
        "report_allow_list": _report_allow_list,
        "report_alternate_base": _report_alternate_base,
        "payer_extract": _payer_extract,
        "payer_extract_as_of": _payer_extract_as_of,
        "payer_extract_csv": _payer_extract_csv,
        **LLM_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    return STATEMENTS | LLM_STATEMENTS
