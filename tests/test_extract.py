"""The payer investigation: golden trades, the extract job and its CSV form."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tradescribe.plans.investigate import investigation_extract
from tradescribe.plans.report import report
from tradescribe.sources import schemas as S
from tradescribe.sources.extract_csv import read_extract, write_extract

DAY = date(2026, 3, 17)

# Number, side, UPI path, status, Canada, Canadian status, and
# whether the payer is us (O) or the counterparty (C).
GOLDEN = """
    165843477 B Forward       LIVE   - Y O
    166160744 B Forward       LIVE   N Y O
    166160895 B ComplexExotic MKT_OP Y Y C
    166781818 S Forward       LIVE   Y Y C
    166883441 S Forward       LIVE   N N O
    166893118 B Forward       LIVE   N N O
    166893480 S Forward       LIVE   - Y C
    166893835 S Forward       LIVE   - Y C
"""
ROWS = [[None if cell == "-" else cell for cell in line.split()] for line in GOLDEN.strip().splitlines()]


def frame(spark, rows, schema):
    return spark.createDataFrame([tuple(row.get(f.name) for f in schema) for row in rows], schema)


@pytest.fixture(scope="module")
def inputs(spark):
    trades = [
        {
            "NB": nb,
            "THD_VALUE_DATE": DAY,
            "HS_CNTRP": f"C{nb}",
            "H_BS": side,
            "H_PRODUCT": "CURR_FXD_FXD",
            "TRN_FMLY": "CURR",
            "TRN_GRP": "FXD",
            "HS_UPI": f"ForeignExchange:{path}",
            "H_DVCS": "D".ljust(50),
            "TP_STATUS2": status,
        }
        for nb, side, path, status, *_ in ROWS
    ]
    counterparties = [
        {
            "MUREX_COUNTERPART": f"C{nb}",
            "RPY_VALUE_DATE": DAY,
            "AGENT_ID": "A",
            "LEI": None if side == "S" else f"LEI{nb}",
            "NAME": "Name",
            "CANADA": canada,
            "CANADIAN_DERIVATIVE_STATUS": canadian,
        }
        for nb, side, _, _, canada, canadian, _ in ROWS
    ]
    return (
        frame(spark, trades, S.TRADES),
        frame(spark, counterparties, S.COUNTERPARTIES),
        frame(spark, [], S.FIXFLOWS),
    )


def test_golden_payers(inputs):
    got = {row["NB"]: row["PAYER_IDENTIFIER_LEG_1"] for row in report(*inputs).collect()}
    own = "BSGEFEIOM18Y80CKCV46"
    for nb, side, *_, payer in ROWS:
        they = f"{own}Name" if side == "S" else f"LEI{nb}"
        assert got[nb] == (own if payer == "O" else they), nb


def test_own_lei_is_an_option(inputs):
    got = report(*inputs, own_lei="OTHERLEI").select("COUNTERPARTY_1", "PAYER_IDENTIFIER_LEG_1").collect()
    assert {row[0] for row in got} == {"OTHERLEI"}
    assert not any("BSGE" in row[1] for row in got)


def test_report_types(inputs):
    result = report(*inputs)
    assert result.columns == S.REPORT_COLUMNS
    kinds = {f.name: f.dataType.simpleString() for f in result.schema}
    assert kinds.pop("EVENT_TIMESTAMP") == "timestamp_ntz"
    assert kinds.pop("QTY_FREQ_MULT_LEG_1") == kinds.pop("QTY_FREQ_MULT_LEG_2") == "int"
    assert set(kinds.values()) == {"string"}


def test_extract_round_trip(spark, inputs, tmp_path):
    trades, counterparties, _ = inputs
    suspects = spark.createDataFrame([(row[0],) for row in ROWS[:5]] * 2, "number string")
    extract = investigation_extract(trades, counterparties, suspects)
    assert extract.columns == S.EXTRACT_COLUMNS
    assert extract.count() == 5
    write_extract(extract, str(tmp_path / "out"))
    back = read_extract(spark, str(tmp_path / "out"))
    assert sorted(map(repr, back.collect())) == sorted(map(repr, extract.collect()))


def test_reads_padded_extract_with_windows_line_ends(spark, tmp_path):
    path = tmp_path / "extract.csv"
    line = ["1", "B", "CURR_FXD_FXD", "ForeignExchange:Forward", "D".ljust(50), "LIVE", "", "Y", ""]
    path.write_bytes((",".join(S.EXTRACT_COLUMNS) + "\r\n" + ",".join(line) + "\r\n").encode())
    row = read_extract(spark, str(path)).first()
    assert row["H_DVCS"] == "D".ljust(50)
    assert row["CANADA"] is None and row["CLEARING_THRESHOLD_EXEEDED"] is None


def test_other_columns_can_be_investigated(spark, inputs):
    trades, counterparties, _ = inputs
    suspects = spark.createDataFrame([(ROWS[0][0],)], "number string")
    extract = investigation_extract(trades, counterparties, suspects, ["NB", "CPTY_LEI", "MATCH_SOURCE"])
    assert [tuple(row) for row in extract.collect()] == [(ROWS[0][0], f"LEI{ROWS[0][0]}", "HS_CNTRP")]


def test_view_by_value_date(spark, inputs, tmp_path):
    """Tables laid out by value date: an as-of report reads one folder."""
    from tradescribe.sources import layout, tables as T

    paths = [str(tmp_path / name) for name in ("t", "c", "f")]
    for df, path, column in zip(inputs, paths, ("THD_VALUE_DATE", "RPY_VALUE_DATE", "FFL_VALUE_DATE")):
        layout.write_by_value_date(df, path, column)
    stored = T.read_trades(spark, paths[0]), T.read_counterparties(spark, paths[1]), inputs[2]
    assert report(*stored, as_of=DAY).count() == len(ROWS)
    plan = report(*stored, as_of=date(2020, 1, 1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(THD_VALUE_DATE" in plan
    assert report(*stored, as_of=date(2020, 1, 1)).count() == 0
    assert report(*stored, allow_list=spark.createDataFrame([(166160744,)], "n bigint")).count() == 1
    assert report(*stored).where(F.col("NB") == "166160744").count() == 1
