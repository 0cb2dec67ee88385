"""Stored layouts: what a report reads and shuffles of them, with the same result."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests import hard_tables
from tests.test_plans import conf, plan
from tradescribe.operators.counterparty import latest_versions
from tradescribe.operators.snapshots import updated_dates, updated_snapshot, version_snapshot
from tradescribe.operators.trades import base_trades, on_list
from tradescribe.plans.report import report
from tradescribe.session import BY_TRADE_CONF
from tradescribe.sources import extract_csv, layout, schemas as S, tables as T

DATES = {"trades": "THD_VALUE_DATE", "counterparties": "RPY_VALUE_DATE", "fixflows": "FFL_VALUE_DATE"}
READ = {"trades": T.read_trades, "counterparties": T.read_counterparties, "fixflows": T.read_fixflows}
PARTS = 16


@pytest.fixture(scope="module")
def plain(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("plain"))
    hard_tables.write(spark, folder)
    return tuple(read(spark, f"{folder}/raw_{name}") for name, read in READ.items())


@pytest.fixture(scope="module")
def dated(spark, plain, tmp_path_factory):
    """By value date, trades and flows by number parts below."""
    folder = str(tmp_path_factory.mktemp("dated"))
    for (name, column), df in zip(DATES.items(), plain):
        layout.write_by_value_date(df, f"{folder}/{name}", column, None if name == "counterparties" else PARTS)
    return tuple(read(spark, f"{folder}/{name}") for name, read in READ.items())


@pytest.fixture(scope="module")
def bucketed(spark, plain, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("bucketed"))
    names = {name: f"by_trade_{name}" for name in ("trades", "fixflows")}
    for name, table in names.items():
        layout.write_by_trade(plain[list(DATES).index(name)], table, f"{folder}/{name}", 8)
    yield spark.table(names["trades"]), plain[1], spark.table(names["fixflows"])
    for table in names.values():
        spark.sql(f"DROP TABLE {table}")


def rows(df):
    return sorted(map(repr, df.collect()))


def executed(df):
    df.collect()
    return plan(df).split("+- == Initial Plan ==")[0]


def scanned(df, name):
    """Rows that came out of the executed scans of one table."""
    tree = df._jdf.queryExecution().executedPlan()
    df.collect()
    found = []

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        if kind == "FileSourceScanExec" and f"/{name}" in node.toString():
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(tree)
    return sum(found)


def test_a_table_in_parts_reports_as_before(plain, dated):
    assert rows(report(*dated)) == rows(report(*plain))


def test_several_dates_prune_all_three_tables_while_they_run(spark, plain, dated):
    days = spark.createDataFrame([(hard_tables.DAYS[0],), (hard_tables.DAYS[2],), (hard_tables.DAYS[0],), (None,)], "day date")
    text = plan(report(*dated, as_of=days))
    for name in DATES:
        lines = text.splitlines()
        scans = [i for i, line in enumerate(lines) if f"/{name}" in line and "FileScan" in line]
        # Long filters are cut in the line; the subquery that fills them stands below it.
        assert scans and all("dynamicpruning" in lines[i] + lines[i + 1] for i in scans), name
    wanted = F.col("THD_VALUE_DATE").isin(hard_tables.DAYS[0], hard_tables.DAYS[2])
    chosen = plain[0].where(wanted)
    expected = rows(report(chosen, plain[1], plain[2]))
    assert rows(report(*dated, as_of=days)) == expected == rows(report(*plain, as_of=days))
    assert rows(report(*plain, as_of=days.where("day = '2026-03-17'"))) == rows(report(*plain, as_of=date(2026, 3, 17)))
    assert report(*dated, as_of=days.where("day is null")).count() == 0


def test_a_list_prunes_the_files_of_the_flows(spark, dated):
    """Rows out of the scan fall with the list's length."""
    flows = dated[2]
    everything = flows.count()

    def read(numbers):
        wanted = spark.createDataFrame([(n,) for n in numbers], "NB string")
        listed = on_list(T.normal_fixflows(layout.in_parts_of(flows, wanted)), wanted)
        return scanned(listed.select("NB", "DT_CAPREM0"), "fixflows"), listed.count()

    few, few_found = read(["5"])
    some, some_found = read(["5", "70", "333", "801"])
    many, _ = read([str(i) for i in range(900)])
    assert few_found == flows.where("NB = '5'").count() and some_found == flows.where("NB in ('5', '70', '333', '801')").count()
    assert 0 < few < some < everything and many == everything
    assert few < everything / 3


def test_a_list_gives_the_same_report_on_every_layout(spark, plain, dated):
    numbers = spark.createDataFrame([(" 1 ",), ("7",), ("7",), ("123",), ("none",), (None,)], "n string")
    expected = rows(report(*plain, allow_list=numbers))
    assert expected and rows(report(*dated, allow_list=numbers)) == expected
    text = plan(base_trades(dated[0], allow_list=numbers))
    assert "dynamicpruning" in text
    whole = spark.createDataFrame([(1,), (7,), (123,)], "n long")
    assert rows(report(*dated, allow_list=whole)) == expected


def test_flows_in_buckets_are_not_shuffled(spark, plain, bucketed):
    static = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__enabled": "false"}
    by_trade = {name.replace(".", "__"): value for name, value in BY_TRADE_CONF.items()}
    with conf(spark, **static, **by_trade):
        text = plan(report(*bucketed, by_trade=True))
        assert rows(report(*bucketed, by_trade=True)) == rows(report(*plain))
    lines = text.splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan" in line and "/fixflows" in line]
    assert scans and all("Bucketed: true" in lines[i] for i in scans)
    for i in scans:
        depth = re.search(r"\w", lines[i]).start()
        for line in lines[i::-1]:  # upwards, through the parents only
            own = re.search(r"\w", line).start()
            if own < depth:
                depth = own
                assert "Exchange" not in line, line
    with conf(spark, **static):
        assert rows(report(*bucketed)) == rows(report(*plain))


def test_snapshot_and_increment_equal_the_full_run(spark, plain):
    """In any split of the versions, with ties and versions that come twice."""
    versions = plain[1]
    expected = rows(latest_versions(versions))
    third = F.pmod(F.xxhash64("AGENT_ID", "LEI", "SYS_CREAT_DTMS"), F.lit(3))
    snapshot = version_snapshot(versions.where(third == 0))
    for increment in (versions.where(third > 0), versions):
        assert rows(latest_versions(updated_snapshot(snapshot, increment))) == expected
    once = updated_snapshot(snapshot, versions.where(third == 1))
    assert rows(updated_snapshot(once, versions.where(third == 2))) == rows(version_snapshot(versions))
    assert rows(report(plain[0], version_snapshot(versions), plain[2])) == rows(report(*plain))


def test_only_the_dates_of_an_increment_are_updated(spark, plain, tmp_path):
    versions = plain[1].where("RPY_VALUE_DATE IS NOT NULL")
    old = F.col("SYS_CREAT_DTMS").isNull()
    days = F.col("RPY_VALUE_DATE").isin(hard_tables.DAYS[1:])
    late = days & ~old
    layout.write_by_value_date(version_snapshot(versions.where(~late)), str(tmp_path / "counterparties"), "RPY_VALUE_DATE")
    snapshot = T.read_counterparties(spark, str(tmp_path / "counterparties"))
    updated = updated_dates(snapshot, versions.where(late))
    assert "dynamicpruning" in plan(updated)
    assert rows(updated) == rows(version_snapshot(versions).where(days))


def test_rejected_lines_of_an_extract(spark, tmp_path):
    good = ["165843477,B,CURR_FXD_FXD,ForeignExchange:Forward," + "D".ljust(50) + ",LIVE,,Y,", "7,S,,,,,,,"]
    bad = {"165843478,B,CURR_FXD_FXD": "fields", ",".join("123456789") + ",0": "fields", "x1,B,,,,,,,": "number", ",B,,,,,,,N": "number"}
    path = tmp_path / "extract.csv"
    path.write_text("\n".join([",".join(S.EXTRACT_COLUMNS), *good, *bad, ""]) + "\n")
    checked = extract_csv.checked_extract(spark, str(path))
    assert {r.NB for r in extract_csv.accepted(checked).collect()} == {"165843477", "7"}
    assert next(r for r in extract_csv.accepted(checked).collect() if r.NB != "7").H_DVCS == "D".ljust(50)
    assert {tuple(r) for r in extract_csv.rejected(checked).collect()} == set(bad.items())
    assert extract_csv.accepted(checked).columns == S.EXTRACT_COLUMNS


def test_scratch_paths_are_new(spark):
    assert layout.scratch_path(spark, "x") != layout.scratch_path(spark, "x")
