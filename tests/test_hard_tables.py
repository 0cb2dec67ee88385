"""Every operator against the plain rules on tables made to be difficult."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from oracle import rules as R
from oracle.statements import statement
from tests import hard_tables
from tests.compare import differences
from tradescribe.operators import classify
from tradescribe.operators.counterparty import (
    MATCH_COLUMNS,
    latest_versions,
    matched_trades,
    relevant_counterparties,
    relevant_keys,
)
from tradescribe.operators.schedule import frequencies, next_schedule_dates, notionals
from tradescribe.operators.trades import base_trades
from tradescribe.plans.report import report
from tradescribe.sources import tables as T
from tradescribe.sources.schemas import COUNTERPARTIES, REPORT_COLUMNS

RULES = [R.BASE, R.COUNTERPARTY, R.CLASSES, R.schedule(), R.FIELDS, R.REPORT]


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("hard"))
    hard_tables.write(spark, folder)
    con = duckdb.connect()
    for name in ("raw_trades", "raw_counterparties", "raw_fixflows"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}/*.parquet')")
    return (
        con,
        T.read_trades(spark, f"{folder}/raw_trades"),
        T.read_counterparties(spark, f"{folder}/raw_counterparties"),
        T.read_fixflows(spark, f"{folder}/raw_fixflows"),
    )


def check(df, con, select, rules=RULES):
    assert differences(df, con, statement(select, *rules)) == ""


def test_report(data):
    con, trades, counterparties, fixflows = data
    check(report(trades, counterparties, fixflows), con, f"SELECT {', '.join(REPORT_COLUMNS)} FROM reported")


def test_every_field_takes_every_value(data):
    """The tables reach all codes a field can report, so that parity covers them."""
    con, *_ = data
    expected = {
        "CLEARING_CPTY_2": {"AFFL", "ENDU", "SMBK", "COOP", "NOAL", "OTHR", None},
        "PARTY_TYP2": {"PLID", "LEID", "NPID", None},
        "QUANTITY_UNIT_MEASURE_LEG_1": {"IPNT", "SHAS", "ACCY", "BARL", "MBTU", "MWHO", "OZTR", "KILO", "BUSL", "OTHR"},
        "QUANTITY_UNIT_MEASURE_LEG_2": {"ACCY", "BARL", "MBTU", "MWHO", "OZTR", "KILO", "BUSL", "OTHR", None},
        "QTY_FREQUENCY_LEG_1": {"DAIL", "MNTH", "EXPI", None},
        "QTY_FREQUENCY_LEG_2": {"DAIL", "MNTH", "EXPI", None},
        "PACKAGE_TRAN_PRICE_NOTAT": {"1", "3", "EROR", None},
        "PACKAGE_TRAN_SPREAD_NOTAT": {"1", "3", "4", None},
        "EMBEDDED_OPTION": {"MDET", "OTHR", "CANC", "OPET", "EXTD", None},
        "DELIVERY_TYPE": {"CASH", "PHYS", "OPTL", None},
        "BASE_DIRECTION": {"SLLR", "BYER", None},
        "CLEARED": {"Y", "I", "N"},
        "CAN_CLEARABLE": {"Y", "N"},
    }
    for field, values in expected.items():
        rows = con.execute(statement(f"SELECT DISTINCT {field} FROM reported", *RULES)).fetchall()
        assert {row[0] for row in rows} == values, field
    for field in REPORT_COLUMNS:
        if field not in ("CALL_AMOUNT_LEG_2", "CALL_CURR_LEG_2", "PUT_AMOUNT_LEG_2", "PUT_CURR_LEG_2"):
            some = con.execute(statement(f"SELECT count({field}) FROM reported", *RULES)).fetchone()[0]
            assert some > 5, field


@pytest.mark.parametrize(
    "name, rule",
    [("DELIVERY_TYPE", classify.delivery_type), ("BASE_DIRECTION", classify.base_direction)],
)
def test_unreported_classifiers(data, name, rule):
    con, trades, *_ = data
    check(base_trades(trades).select("NB", "THD_VALUE_DATE", rule().alias(name)), con, f"SELECT NB, THD_VALUE_DATE, {name} FROM k")


def test_counterparties(data):
    con, trades, counterparties, _ = data
    base = base_trades(trades)
    names = ", ".join(f.name for f in COUNTERPARTIES)
    check(relevant_keys(base), con, "SELECT d AS RPY_VALUE_DATE, code AS MUREX_COUNTERPART FROM wanted WHERE d IS NOT NULL OR true")
    check(relevant_counterparties(base, counterparties), con, f"SELECT {names} FROM relevant")
    check(
        latest_versions(relevant_counterparties(base, counterparties)),
        con,
        f"SELECT MUREX_COUNTERPART, RPY_VALUE_DATE, {', '.join(R.ATTRIBUTES)} FROM newest",
    )
    check(
        matched_trades(base, counterparties).select("NB", "THD_VALUE_DATE", "HS_CNTRP", *MATCH_COLUMNS),
        con,
        f"SELECT NB, THD_VALUE_DATE, HS_CNTRP, {', '.join(MATCH_COLUMNS)} FROM m",
    )


@pytest.mark.parametrize("cap", [4, 5, 6, 7, 8, 20, 21, 22, 4000, 4001, 100_000])
def test_notionals(data, cap):
    """The hot trade's list is cut at most caps, and so tests the bounded prefix."""
    con, trades, _, fixflows = data
    result = notionals(base_trades(trades), T.normal_fixflows(fixflows), cap=cap)
    check(result, con, "SELECT NB, CONCAT_CAPREM0 FROM notional", [R.BASE, R.schedule(cap)])


def test_schedule_steps(data):
    con, trades, _, fixflows = data
    base, flows = base_trades(trades), T.normal_fixflows(fixflows)
    check(next_schedule_dates(base, flows), con, "SELECT NB, THD_VALUE_DATE, DT_LEG0, LEGSTEP, DATE2, NEXT_DATE2 FROM steps")
    check(frequencies(base, flows), con, "SELECT * FROM frequency")


def test_one_row_per_trade(data):
    _, trades, counterparties, fixflows = data
    result = report(trades, counterparties, fixflows)
    assert result.count() == trades.count()
    own = F.lit("BSGEFEIOM18Y80CKCV46")
    assert result.where((F.col("BUYER_IDENTIFIER") == own) & (F.col("SELLER_IDENTIFIER") == own)).isEmpty()
    assert result.where(F.col("COUNTERPARTY_2").isNull()).isEmpty()


def test_same_result_for_any_partitioning(spark, data):
    _, trades, counterparties, fixflows = data

    def digest():
        result = report(trades, counterparties, fixflows)
        return result.agg(F.sum(F.xxhash64(*REPORT_COLUMNS).cast("decimal(38,0)"))).first()[0]

    before = spark.conf.get("spark.sql.shuffle.partitions")
    digests = set()
    try:
        for partitions in ("1", "3", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            digests.add(digest())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(digests) == 1
