"""Physical plans: what is read, what is joined, and how hot keys are split."""

from __future__ import annotations

import re
from contextlib import contextmanager
from datetime import date

import pytest
from pyspark.sql import functions as F

from tradescribe.operators.counterparty import match_table, attach_match, relevant_counterparties, with_match_keys
from tradescribe.operators.schedule import (
    elements_that_fit,
    flow_frequencies,
    frequencies,
    listed_prefixes,
    notional_flows,
    notionals,
    schedules,
)
from tradescribe.operators.trades import base_trades
from tradescribe.plans.consumer import buyers
from tradescribe.plans.report import publish, report
from tradescribe.sources import driver_tables as D, schemas as S, tables as T

SF_DIR = "/root/testdata/sf0.01"
HOT_CODE, HOT_DAY, HOT_TRADE = "Customer#000000001", "1998-03-01", "7"


@contextmanager
def conf(spark, **settings):
    names = {name.replace("__", "."): value for name, value in settings.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan(df) -> str:
    with conf(df.sparkSession, spark__sql__maxMetadataValueLength="10000"):
        return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The three tables in several files each.

    A third of all trades, versions and flows belongs to one counterparty or
    trade, on one day.
    """
    folder = str(tmp_path_factory.mktemp("hot"))
    hot = F.pmod(F.xxhash64("NB"), F.lit(3)) == 0
    day = F.lit(HOT_DAY).cast("date")
    trades = D.trades(spark, SF_DIR).withColumns(
        {
            "HS_CNTRP": F.when(hot, HOT_CODE).otherwise(F.col("HS_CNTRP")),
            "THD_VALUE_DATE": F.when(hot, day).otherwise(F.col("THD_VALUE_DATE")),
        }
    )
    extra = D.counterparties(spark, SF_DIR).where(F.month("RPY_VALUE_DATE") <= 6).withColumns(
        {"MUREX_COUNTERPART": F.lit(HOT_CODE), "RPY_VALUE_DATE": day}
    )
    seven = trades.where(F.col("NB") == HOT_TRADE).select(F.col("THD_VALUE_DATE").alias("d"))
    flows = D.fixflows(spark, SF_DIR)
    third = F.pmod(F.xxhash64("NB", "LEGSTEP", "DT_CAPREM0"), F.lit(3)) == 0
    flows = (
        flows.join(F.broadcast(seven))
        .withColumns(
            {
                "NB": F.when(third, HOT_TRADE).otherwise(F.col("NB")),
                "FFL_VALUE_DATE": F.when(third, F.col("d")).otherwise(F.col("FFL_VALUE_DATE")),
            }
        )
        .drop("d")
    )
    tables = {
        "trades": trades.repartition(8),
        "counterparties": D.counterparties(spark, SF_DIR).unionAll(extra).repartition(8),
        "fixflows": flows.repartition(8),
    }
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}")
    return (
        T.read_trades(spark, f"{folder}/trades"),
        T.read_counterparties(spark, f"{folder}/counterparties"),
        T.read_fixflows(spark, f"{folder}/fixflows"),
    )


def test_only_builtin_expressions_and_equi_joins(stored):
    text = plan(report(*stored))
    assert "Python" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_trade_fields_read_trades_only(stored):
    text = plan(report(*stored).select("NB", "CLEARED", "QUANTITY_UNIT_MEASURE_LEG_1"))
    assert "Join" not in text and "partitioning" not in text
    assert text.count("FileScan") == 1
    columns = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert sorted(c.split(":")[0] for c in columns.split(",")) == sorted(
        "NB M_CCP_NAME M_AUTO_CLR M_CLEAR_STS HS_UPI".split()
    )


def test_buyers_do_not_read_flows(stored):
    text = plan(buyers(*stored))
    assert "/fixflows" not in text and "/counterparties" in text


def test_view_prunes_like_the_plan(spark, stored):
    publish(*stored, name="pruned_report")
    text = plan(spark.sql("SELECT NB, QTY_FREQUENCY_LEG_1 FROM pruned_report"))
    assert "/fixflows" in text and "/counterparties" not in text


def test_flow_filters_reach_the_scan(stored):
    flows = notional_flows(T.normal_fixflows(stored[2]))
    text = flows._sc._jvm.PythonSQLUtils.explainString(flows._jdf.queryExecution(), "formatted")
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    for wanted in ("EqualTo(FIXVAR,F1)", "EqualTo(FIXVAR1,F)", "EqualTo(AMORTFLAG,Y)", "EqualTo(EQDSIDE,N)"):
        assert wanted in pushed


def test_notionals_are_bounded_before_the_shuffle(stored):
    text = plan(notionals(base_trades(stored[0]), T.normal_fixflows(stored[2])))
    limits = re.findall(r"WindowGroupLimit .*?(Partial|Final)", text)
    assert "Partial" in limits


def test_frequencies_aggregate_by_hash_before_the_shuffle(stored):
    text = plan(frequencies(base_trades(stored[0]), T.normal_fixflows(stored[2])))
    assert "SortAggregate" not in text
    assert "partial_min(" in text


SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__shuffle__partitions": "16",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20k",
    "spark__sql__adaptive__coalescePartitions__parallelismFirst": "false",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "40k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
}


def fingerprint(df):
    return sorted(map(repr, df.collect()))


def split_joins(spark, build, **sizes):
    """Skew-split joins of the executed plan; checks that the result is the same."""
    with conf(spark, **SKEW | sizes):
        df = build()
        split = fingerprint(df)
        text = plan(df)
    with conf(spark, spark__sql__adaptive__enabled="false"):
        assert fingerprint(build()) == split
    return [line for line in text.split("+- == Initial Plan ==")[0].splitlines() if "skew=true" in line]


def test_hot_counterparty_is_split_over_trades(spark, stored):
    trades, counterparties, _ = stored

    def build():
        base = base_trades(trades)
        matched = attach_match(with_match_keys(base), match_table(base, counterparties))
        return matched.select("NB", "CPTY_LEI", "MATCH_SOURCE")

    assert split_joins(spark, build)


def test_hot_fallback_is_split(spark, stored):
    """Unknown primaries, all different, half of them with one fallback code on one date."""
    _, counterparties, _ = stored
    code = counterparties.where("RPY_VALUE_DATE = DATE '1997-05-01'").agg(F.min("MUREX_COUNTERPART")).first()[0]
    half = F.col("id") % 2 == 0
    trades = spark.range(15_000).select(
        *[
            {
                "NB": F.col("id").cast("string"),
                "THD_VALUE_DATE": F.lit(date(1997, 5, 1)),
                "HS_CNTRP": F.concat(F.lit("unknown"), "id"),
                "H_INT": F.lit("Y"),
                "D_CTP_ENT": F.when(half, code).otherwise(F.concat(F.lit("other"), "id")),
            }
            .get(field.name, F.lit(None).cast(field.dataType))
            .alias(field.name)
            for field in S.TRADES
        ]
    )
    base = base_trades(trades)
    # Codes are short, so the sizes that count as large are small here, and no task takes them all.
    small = {
        "spark__sql__adaptive__coalescePartitions__enabled": "false",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "4k",
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "8k",
    }
    assert split_joins(
        spark, lambda: match_table(base, counterparties).select("PRIMARY_CODE", "MATCH_SOURCE"), **small
    )


def test_allow_list_restricts_versions_and_flows(spark, stored):
    """The list is joined below the aggregates of the flows, and the keys below that of the versions."""
    numbers = spark.createDataFrame([("1",), ("2",)], "NB string")
    text = plan(report(*stored, allow_list=numbers))
    flow_scans = [line for line in text.splitlines() if "/fixflows" in line]
    assert flow_scans and text.count("LeftSemi") >= len(flow_scans) + 1
    assert plan(report(*stored)).count("LeftSemi") >= 1


def test_a_large_cap_keeps_the_partial_limit(stored):
    text = plan(notionals(base_trades(stored[0]), T.normal_fixflows(stored[2]), cap=100_000))
    assert re.findall(r"WindowGroupLimit .*?(Partial|Final)", text).count("Partial") >= 1


def test_hot_counterparty_is_split_over_versions(spark, stored):
    trades, counterparties, _ = stored
    wanted = ["MUREX_COUNTERPART", "AGENT_ID", "LEI"]
    assert split_joins(spark, lambda: relevant_counterparties(base_trades(trades), counterparties).select(*wanted))


def test_hot_trade_is_split_over_flows(spark, stored):
    trades, _, fixflows = stored
    assert split_joins(spark, lambda: notionals(base_trades(trades), T.normal_fixflows(fixflows)))


def test_copies_of_one_trade_are_split(spark, stored):
    """A third of all rows are one trade on one day: the schedule join is cut too."""
    trades, counterparties, fixflows = stored
    third = F.pmod(F.xxhash64("NB"), F.lit(3)) == 1
    copies = trades.withColumns(
        {
            "NB": F.when(third, HOT_TRADE).otherwise(F.col("NB")),
            "THD_VALUE_DATE": F.when(third, F.lit(HOT_DAY).cast("date")).otherwise(F.col("THD_VALUE_DATE")),
        }
    )
    fields = ["NB", "EVENT_IDENTIFIER", "QTY_FREQUENCY_LEG_1", "QTY_FREQ_MULT_LEG_1"]
    assert split_joins(spark, lambda: report(copies, counterparties, fixflows).select(*fields))


def test_report_is_the_same_when_split(spark, stored):
    assert split_joins(spark, lambda: report(*stored))


def test_copies_of_one_trade_are_sorted_in_pieces(spark, stored):
    """Rows of one number that are all equal still reach several tasks."""
    from tradescribe.functions import rows

    trades, counterparties, fixflows = stored
    copies = trades.withColumns({"NB": F.lit("1"), "TRN_FMLY": F.lit("COM"), "TRN_GRP": F.lit("SWAP")})
    piece, rows.PIECE = rows.PIECE, 100
    try:
        with conf(spark, spark__sql__adaptive__enabled="false"):
            result = buyers(copies, counterparties, fixflows)
            per_task = [row["count"] for row in result.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        rows.PIECE = piece
    assert sum(per_task) == trades.count()
    assert len(per_task) > 1 and max(per_task) < sum(per_task) / 2


def spread_trade(spark, tasks, rows):
    """One trade, half of whose flows are twins, in so many map tasks, and a small one."""
    one = {"NB": "'1'", "THD_VALUE_DATE": "DATE '1998-03-01'", "TRN_GRP": "'IRS'"}
    trades = spark.range(2).selectExpr(
        *[f"CAST({'id + 1' if f.name == 'NB' else one.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in S.TRADES]
    )
    flow = {
        "NB": "if(id % 1000 = 7, '2', '1')",
        "FFL_VALUE_DATE": "DATE '1998-03-01'",
        "LEGSTEP": "if(id % 2 = 0, 5, id % 100)",
        "DT_LEG0": "0",
        "DATE2": "DATE '1998-04-01'",
        "DATE4": "DATE '1998-05-01'",
        "DT_CAPREM0": "if(id % 2 = 0, 10, id)",
        "FIXVAR": "'F1'",
        "FIXVAR1": "'F'",
        "AMORTFLAG": "'Y'",
        "EQDSIDE": "'N'",
    }
    flows = spark.range(0, tasks * rows, 1, tasks).selectExpr(
        *[f"CAST({flow[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in S.FIXFLOWS]
    )
    return base_trades(trades), T.normal_fixflows(flows)


def test_the_list_of_a_trade_in_many_tasks_merges_in_levels(spark):
    """Its last task reads two prefixes, and the list is the one of all flows in order."""
    trades, flows = spread_trade(spark, 200, 2_100)
    most = elements_that_fit(4_000)
    # Straight from 200 tasks, as a broadcast of the trades gives them.
    copies = {"HOT": F.col("NB") == "1", "COPIES": F.lit(1).cast("long")}
    few, hot = listed_prefixes(notional_flows(flows).withColumns(copies), most)
    parts = {(r.NB, r.PART): r["count"] for r in hot.groupBy("NB", "PART").count().collect()}
    assert set(parts) == {("1", 0), ("1", 1)} and max(parts.values()) <= most
    assert {r.NB for r in few.select("NB").distinct().collect()} == {"2"}
    lists = {r.NB: r.CONCAT_CAPREM0 for r in notionals(trades, flows).collect()}
    # Every hundredth flow has step 0; these come before step 1 and are even, so step 5 holds them all.
    odd = sorted((i % 100, i) for i in range(200 * 2_100) if i % 2 and i % 1_000 != 7)
    expected = [str(i) for step, i in odd if step < 5][: most]
    text = ",".join(expected)
    assert lists["1"] == text[:3_997][: text[:3_997].rfind(",") + 1] + "..."
    assert lists["2"].startswith("7,1007,2007,")


def test_hot_and_plain_trades_have_the_same_lists(spark, stored):
    """Whatever counts as hot."""
    trades, flows = base_trades(stored[0]), T.normal_fixflows(stored[2])
    assert fingerprint(notionals(trades, flows, cap=20, hot=0)) == fingerprint(notionals(trades, flows, cap=20))


def test_plain_trades_meet_in_one_shuffle(stored):
    """The flows of trades that are not hot are shuffled to the list once: the levels read the same exchange."""
    df = notionals(base_trades(stored[0]), T.normal_fixflows(stored[2]))
    df.collect()
    final = plan(df).split("+- == Initial Plan ==")[0]
    assert "ReusedExchange" in final or final.count("WindowGroupLimit") <= 2


def test_a_match_reads_the_trades_once_and_deals_no_versions(stored):
    """The keys come from the combinations; the versions' aggregate goes straight to the joins' shuffles."""
    df = match_table(base_trades(stored[0]), stored[1])
    assert "REBALANCE" not in plan(df)
    df.collect()
    final = plan(df).split("+- == Initial Plan ==")[0]
    assert final.count("/trades") == 1 and "ReusedExchange" in final


def test_versions_are_not_sorted_for_their_keys(spark, stored):
    """Keys that came out small are hashed; with them, all versions need no sort."""
    never = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"}
    with conf(spark, **never):
        df = relevant_counterparties(base_trades(stored[0]), stored[1])
        df.collect()
        final = plan(df).split("+- == Initial Plan ==")[0]
    assert "ShuffledHashJoin" in final and "SortMergeJoin" not in final


def test_a_list_of_trades_meets_short_rows(spark, stored):
    """What the shuffle for the list carries of a trade are results, not its raw columns."""
    numbers = spark.createDataFrame([("1",), ("2",)], "NB string")
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        df = report(*stored, allow_list=numbers).select("NB", "EVENT_TIMESTAMP", "PACKAGE_INDICATOR", "CLEARED")
        lines = plan(df).splitlines()
    exchange = next(n for n, line in enumerate(lines) if "Exchange hashpartitioning(NB" in line)
    below = [line for line in lines[exchange:] if "Project [" in line]
    assert "AS CLEARED" in below[0]


def test_many_splits_are_not_dealt_again(spark, tmp_path):
    """A file with fewer splits than cores is dealt, a larger one read as it lies; customers spread over the shuffle's tasks."""
    few, many = spark.range(0, 100, 1, 1), spark.range(0, 100, 1, spark.sparkContext.defaultParallelism)
    assert "Exchange" in plan(D._dealt(few, "id")) and "Exchange" not in plan(D._dealt(many, "id"))
    with conf(spark, spark__sql__shuffle__partitions="50"):
        assert D._spread(few, "id").rdd.getNumPartitions() == 50


def executed(df) -> list[str]:
    """The lines of the plan as it ran."""
    df.collect()
    return plan(df).split("+- == Initial Plan ==")[0].splitlines()


def test_line_items_are_shuffled_once(spark):
    """Lists, hot trades and frequencies read the same numbered lines."""
    df = schedules(base_trades(D.trades(spark, SF_DIR)), T.normal_fixflows(D.fixflows(spark, SF_DIR)))
    assert len([line for line in executed(df) if "FileScan" in line and "/lineitem" in line]) == 1


def test_numbered_lines_lie_by_trade(spark):
    """Their frequencies need no shuffle of their own."""
    text = plan(flow_frequencies(T.normal_fixflows(D.fixflows(spark, SF_DIR))))
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text)
    assert keys and all(re.fullmatch(r"number#\d+", key) for key in keys)


def test_copies_are_counted_once(stored):
    lines = executed(schedules(base_trades(stored[0]), T.normal_fixflows(stored[2])))
    assert len([line for line in lines if "FileScan" in line and "/trades" in line]) == 1


def test_both_lookups_read_one_shuffle_of_the_versions(spark, stored):
    """The versions shrink in the map tasks; what is left of them is shuffled once for both lookups."""
    never = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"}
    with conf(spark, **never):
        lines = executed(report(*stored).select("NB", "BUYER_IDENTIFIER"))
    dealt = [line for line in lines if "Exchange hashpartitioning(" in line and "ReusedExchange" not in line]
    assert len([line for line in dealt if "length(MUREX_COUNTERPART" in line]) == 1
    scan = next(n for n, line in enumerate(lines) if "/counterparties" in line)
    exchange = max(n for n, line in enumerate(lines[:scan]) if "Exchange hashpartitioning(" in line)
    assert any("partial_max(" in line for line in lines[exchange:scan])


def test_customers_spread_over_as_many_tasks_as_they_need(spark):
    assert D._spread(spark.range(100), "id", most=1).rdd.getNumPartitions() == 100


def test_attributes_travel_in_one_text(stored):
    """The versions' shuffle, the lookups and the match carry one column for all attributes."""
    text = plan(match_table(base_trades(stored[0]), stored[1]))
    assert re.search(r"partial_max\(struct\(SYS_CREAT_DTMS, SYS_CREAT_DTMS#\d+, ATTRIBUTES_,", text)
    df = match_table(base_trades(stored[0]), stored[1])
    assert "LEI" not in df.columns and set(df.columns) >= {"PRIMARY_CODE", "MATCH_SOURCE"}


def test_compact_report_is_the_same(spark, stored):
    """Its texts travel in one, also where a list of trades is met, and joins are split as in the plain one."""
    numbers = stored[0].select("NB").where("NB % 3 = 0")
    for options in ({}, {"allow_list": numbers}, {"own_lei": ""}, {"by_trade": True}):
        assert fingerprint(report(*stored, **options, compact=True)) == fingerprint(report(*stored, **options))
    assert split_joins(spark, lambda: report(*stored, compact=True))


def test_whole_reports_are_compact(spark):
    import __spark_entry__ as entry

    for name in ("report_full", "report_as_of_dates", "report_allow_list", "report_alternate_base"):
        assert "TEXTS_" in plan(entry.queries()[name](spark, SF_DIR))
