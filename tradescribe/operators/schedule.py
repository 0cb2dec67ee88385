"""Cash-flow schedules: notional list and payment frequency.

Flows are joined with trades reduced to one row per (trade, date).  How often a
trade repeats is kept as a count and worked into the results, so that a group
of copies is never multiplied out against its flows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradescribe import constants as K
from tradescribe.functions.dates import add_months, exact_days_between, months_between, moment_of, seconds_of
from tradescribe.functions.numbers import number_text
from tradescribe.functions.rows import repeat_rows
from tradescribe.session import bounded_groups

# Frequencies in text order, so that the greatest number is the greatest text.
_FREQUENCIES = ("DAIL", "EXPI", "MNTH")
_DAILY, _IRREGULAR, _MONTHLY = 1, 2, 3


# Value dates are joined as day numbers.  A trade without a date keeps a number
# that no flow has: it has no frequency, but its notionals are found by trade
# number alone.
NO_DAY = -(2**31)
TRADE_KEY = ["NB", "DAY"]


def with_day(trades: DataFrame) -> DataFrame:
    """Trades plus the day number that, with NB, finds their schedule."""
    return trades.withColumn("DAY", F.coalesce(F.unix_date("THD_VALUE_DATE"), F.lit(NO_DAY)))


def _flow_day() -> Column:
    return F.unix_date("FFL_VALUE_DATE")


def _value_date() -> Column:
    return F.date_from_unix_date("DAY").alias("THD_VALUE_DATE")


def trade_copies(trades: DataFrame) -> DataFrame:
    """Row count per (trade, day): all rows, and those whose steps count.

    The filter is true of every row.  It keeps both counts in the plan of each
    use, so that they read the same columns and share one shuffle.
    """
    return (
        with_day(trades)
        .where(F.col("NB").isNotNull())
        .groupBy(*TRADE_KEY)
        .agg(
            F.count(F.lit(1)).alias("COPIES"),
            F.count_if(F.col("TRN_GRP") != "RTRN").alias("STEP_COPIES"),
        )
        .where((F.col("COPIES") > 0) & (F.col("STEP_COPIES") >= 0))
    )


# --- notional list -----------------------------------------------------------


def within_horizon() -> Column:
    return F.col("DATE4") <= add_months(F.col("FFL_VALUE_DATE"), K.NOTIONAL_HORIZON_MONTHS)


def notional_flows(fixflows: DataFrame) -> DataFrame:
    """Flows that carry a reportable notional, up to five years ahead."""
    flows = fixflows
    for name, value in K.NOTIONAL_FLOW.items():
        flows = flows.where(F.col(name) == value)
    return flows.where(within_horizon() & F.col("NB").isNotNull()).select(
        "NB", "FFL_VALUE_DATE", "LEGSTEP", "DT_LEG0", "DATE2", "DT_CAPREM0"
    )


def elements_that_fit(cap: int) -> int:
    """A list of this many elements, one byte or more each, exceeds ``cap`` bytes."""
    return (cap + 1) // 2 + 1


def cut_list(text: Column, cap: int) -> Column:
    """Cut an overlong list after its last whole element and mark the cut.

    Assumed rule: the kept elements, each with its separator, and the mark
    together take at most ``cap`` bytes.
    """
    head = F.substring(text, 1, cap - len(K.LIST_ELLIPSIS))
    broken = F.substring_index(head, K.LIST_SEPARATOR, -1)
    whole = F.when(broken != head, F.left(head, F.length(head) - F.length(broken))).otherwise("")
    return F.when(F.octet_length(text) > cap, F.concat(whole, F.lit(K.LIST_ELLIPSIS))).otherwise(text)


# A trade with more listed flows than this is merged in levels.
HOT_FLOWS = 16_000

# Parts that the map tasks' prefixes of such a trade merge into, level by level; the last two make one.
LEVELS = (256, 16, 2)


def hot_trades(fixflows: DataFrame, most: int, hot: int = HOT_FLOWS) -> DataFrame:
    """Trade numbers with more listed flows than ``hot``, and than a few prefixes have."""
    counted = notional_flows(fixflows).groupBy("NB").agg(F.count(F.lit(1)).alias("FLOWS"))
    return counted.where(F.col("FLOWS") > max(hot, 8 * most)).select(F.col("NB").alias("HOT_TRADE"))


def listed_flows(
    trades: DataFrame, fixflows: DataFrame, most: int, *, by_trade: bool = False, hot: int = HOT_FLOWS
) -> DataFrame:
    """Flows of the reported trades with the trade's copies, and whether the trade is hot.

    The flows come into the join straight from their shuffle (the null-safe
    comparison gives the trade side its own), which lets adaptive execution
    split a hot trade there.  ``by_trade`` leaves both out: flows in buckets of
    trade numbers need no shuffle, and a trade lies in one of them.
    """
    copies = trade_copies(trades).select(
        F.col("NB").alias("TRADE"), F.col("DAY").alias("TRADE_DAY"), "COPIES", "STEP_COPIES"
    )
    same_day = _flow_day() == F.col("TRADE_DAY")
    if by_trade:
        return notional_flows(fixflows).join(copies, (F.col("NB") == F.col("TRADE")) & same_day)
    # At most one trade for so many flows: short enough to tell all executors.
    hot_ones = F.broadcast(hot_trades(fixflows, most, hot))
    copies = copies.join(hot_ones, F.col("TRADE") == F.col("HOT_TRADE"), "left").withColumn(
        "HOT", F.col("HOT_TRADE").isNotNull()
    )
    return notional_flows(fixflows).join(copies, F.col("NB").eqNullSafe(F.col("TRADE")) & same_day)


def _prefix(flows: DataFrame, most: int) -> DataFrame:
    """The first flows of every part of a trade, with their position."""
    in_order = Window.partitionBy("NB", "PART").orderBy(
        F.col("DT_CAPREM0").isNull(),
        F.asc_nulls_last("LEGSTEP"),
        F.asc("FFL_VALUE_DATE"),
        F.asc_nulls_last("DT_LEG0"),
        F.asc_nulls_last("DATE2"),
        F.asc("DT_CAPREM0"),
    )
    return flows.withColumn("POSITION", F.row_number().over(in_order)).where(F.col("POSITION") <= most)


def listed_prefixes(listed: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The first flows of trades that are not hot, and of those that are, the latter still in the two parts of the last level.

    The first flows of several parts together are the first of the parts' first
    flows.  So a trade spread over any number of map tasks merges in levels, and
    its last task reads two prefixes.  Which part a flow takes depends on its
    task, what comes out does not.
    """
    part = F.when(F.col("HOT"), F.pmod(F.spark_partition_id(), F.lit(LEVELS[0]))).otherwise(0)
    first = _prefix(listed.withColumn("PART", part), most)
    hot = first.where("HOT")
    for parts in LEVELS[1:]:
        hot = _prefix(hot.withColumn("PART", F.pmod("PART", F.lit(parts))), most)
    return first.where(~F.col("HOT")), hot


def notionals(
    trades: DataFrame,
    fixflows: DataFrame,
    *,
    cap: int = K.LIST_CAP,
    by_trade: bool = False,
    hot: int = HOT_FLOWS,
) -> DataFrame:
    """Comma-separated notionals per trade number, in schedule order.

    The list spans all value dates of a trade number, as it is attached by
    number alone.  Flows of one step are ordered by value date, leg, start date
    and amount.

    Only the elements that can fit are kept, which changes no list: the cut
    looks at no element behind them.  The rank filter works inside the map
    tasks first, so even a trade that owns a third of all flows sends a bounded
    number of them from each, and these merge in levels.
    """
    most = elements_that_fit(cap)
    bounded_groups(trades.sparkSession, most)
    if by_trade:
        listed = listed_flows(trades, fixflows, most, by_trade=True)
        lists = _lists(_prefix(listed.withColumn("PART", F.lit(0)), most), most, cap)
    else:
        few, hot_ones = listed_prefixes(listed_flows(trades, fixflows, most, hot=hot), most)
        merged = _prefix(hot_ones.withColumn("PART", F.lit(0)), most)
        lists = _lists(few, most, cap).unionAll(_lists(merged, most, cap))
    # A trade is in one of the two; the aggregate tells the optimizer that its number is unique.
    return lists.groupBy("NB").agg(F.max("CONCAT_CAPREM0").alias("CONCAT_CAPREM0"))


def _lists(flows: DataFrame, most: int, cap: int) -> DataFrame:
    element = number_text(F.col("DT_CAPREM0"))
    room = F.lit(most + 1) - F.col("POSITION")
    times = F.least(F.col("COPIES"), room).cast("int")
    return (
        flows.select(
            "NB",
            "PART",
            "POSITION",
            F.when(times == 1, element)
            .otherwise(F.array_join(F.array_repeat(element, times), K.LIST_SEPARATOR))
            .alias("ELEMENT"),
            element.isNull().alias("SKIPPED"),
        )
        .groupBy("NB", "PART")
        .agg(
            F.expr(
                f"listagg(if(SKIPPED, NULL, ELEMENT), '{K.LIST_SEPARATOR}') WITHIN GROUP (ORDER BY POSITION)"
            ).alias("LIST")
        )
        .select("NB", cut_list(F.col("LIST"), cap).alias("CONCAT_CAPREM0"))
    )


# --- payment frequency -------------------------------------------------------


def dated_steps(fixflows: DataFrame) -> DataFrame:
    """Flows with a start date among the first seventeen schedule steps."""
    return fixflows.where(
        F.col("NB").isNotNull()
        & F.col("DATE2").isNotNull()
        & F.col("LEGSTEP").between(K.FIRST_STEP, K.LAST_STEP)
    ).select("NB", _flow_day().alias("DAY"), "DT_LEG0", "LEGSTEP", "DATE2")


def counted_copies(trades: DataFrame) -> DataFrame:
    """(Trade, date) pairs whose steps count, and how often they do."""
    return trade_copies(trades).where(F.col("STEP_COPIES") > 0)


def next_schedule_dates(trades: DataFrame, fixflows: DataFrame) -> DataFrame:
    """Every dated step with the start date of the step after it on its leg.

    Equal steps are counted before the shuffle; the window then sees distinct
    steps only, at most seventeen per calendar day.  In a run of equal steps
    each is followed by its twin and the last one by the next step.
    """
    key = [*TRADE_KEY, "DT_LEG0", "LEGSTEP", "DATE2"]
    following = F.lead("DATE2").over(
        Window.partitionBy(*TRADE_KEY, "DT_LEG0").orderBy("LEGSTEP", "DATE2")
    )
    steps = (
        dated_steps(fixflows)
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("TWINS"))
        .join(counted_copies(trades), TRADE_KEY)
        .select(*key, (F.col("TWINS") * F.col("STEP_COPIES")).alias("TWINS"), following.alias("FOLLOWING"))
    )
    is_last = F.col("TWIN") == F.col("TWINS")
    return repeat_rows(steps, "TWINS", "TWIN").select(
        "NB",
        _value_date(),
        *key[2:],
        F.when(is_last, F.col("FOLLOWING")).otherwise(F.col("DATE2")).alias("NEXT_DATE2"),
    )


def payment_frequency(start: Column, following: Column) -> Column:
    """Code of the frequency that two successive start dates show."""
    return (
        F.when(following.isNull(), _IRREGULAR)
        .when(exact_days_between(following, start) <= K.DAILY_GAP_DAYS, _DAILY)
        .when(F.round(months_between(following, start)) == 1, _MONTHLY)
        .otherwise(_IRREGULAR)
    )


# A step and its start as one long, ordered by step and then by start.  Seconds
# of the years 1 to 9999 lie between -6.3e10 and 2.6e11.
_SECOND_SHIFT = 100_000_000_000
_STEP_UNIT = 1_000_000_000_000


def _packed_step(step: Column, start: Column) -> Column:
    return step.cast("long") * _STEP_UNIT + (seconds_of(start) + _SECOND_SHIFT)


def _packed_start(packed: Column) -> Column:
    return moment_of(packed % _STEP_UNIT - _SECOND_SHIFT)


def leg_points(fixflows: DataFrame) -> DataFrame:
    """Per leg, one row per opening date and one for the earliest later step.

    Only the first step of a leg and what follows it decide the frequency, so
    each leg shrinks to these rows before any shuffle, by hash aggregation on
    numbers.
    """
    opening = F.when(F.col("LEGSTEP") == K.FIRST_STEP, F.col("DATE2"))
    return (
        dated_steps(fixflows)
        .groupBy(*TRADE_KEY, "DT_LEG0", opening.alias("OPENING"))
        .agg(
            F.count(F.lit(1)).alias("TWINS"),
            F.min(_packed_step(F.col("LEGSTEP"), F.col("DATE2"))).alias("STEP"),
        )
        .withColumn("START", _packed_start(F.col("STEP")))
    )


def flow_frequencies(fixflows: DataFrame) -> DataFrame:
    """Frequency code of both legs per (trade, day) of the flows.

    A leg is regular if its frequency has a multiplier.  Twins need no rows of
    their own.  A twin shows a gap of no days, that is the lowest frequency,
    which never beats the one of its group; but it does make the leg regular.
    """
    # One window over both legs needs the same partitioning as the grouping
    # below, and so costs no shuffle.
    leg_order = Window.partitionBy(*TRADE_KEY).orderBy("DT_LEG0", F.asc_nulls_last("OPENING"))
    same_leg = F.lead("DT_LEG0").over(leg_order).eqNullSafe(F.col("DT_LEG0"))
    is_opening = F.col("OPENING").isNotNull()
    judged = (
        leg_points(fixflows)
        .withColumn("FOLLOWING", F.when(same_leg, F.lead("START").over(leg_order)))
        .withColumn("CODE", F.when(is_opening, payment_frequency(F.col("START"), F.col("FOLLOWING"))))
    )
    regular = is_opening & (F.col("CODE").isin(_DAILY, _MONTHLY) | (F.col("TWINS") > 1))

    def on_leg(leg: int, value: Column) -> Column:
        return F.max(F.when(F.col("DT_LEG0") == leg, value))

    return judged.groupBy(*TRADE_KEY).agg(
        on_leg(0, F.col("CODE")).alias("CODE_1"),
        on_leg(1, F.col("CODE")).alias("CODE_2"),
        on_leg(0, F.when(regular, 1)).alias("REGULAR_1"),
        on_leg(1, F.when(regular, 1)).alias("REGULAR_2"),
    )


def _frequency_fields() -> list[Column]:
    """Report values of the codes; copies of a trade are twins of each other."""
    names = F.array(*[F.lit(name) for name in _FREQUENCIES])

    def name(leg: int) -> Column:
        return F.get(names, F.col(f"CODE_{leg}") - 1).alias(f"QTY_FREQUENCY_LEG_{leg}")

    def multiplier(leg: int) -> Column:
        copied = F.col(f"CODE_{leg}").isNotNull() & (F.col("STEP_COPIES") > 1)
        return F.when(copied, 1).otherwise(F.col(f"REGULAR_{leg}")).alias(f"QTY_FREQ_MULT_LEG_{leg}")

    return [name(1), name(2), multiplier(1), multiplier(2)]


def frequencies(trades: DataFrame, fixflows: DataFrame) -> DataFrame:
    """Payment frequency and its multiplier per (trade, date) with dated steps."""
    found = flow_frequencies(fixflows).join(counted_copies(trades), TRADE_KEY)
    return found.select("NB", _value_date(), *_frequency_fields())


# --- both, per trade and date ------------------------------------------------


def schedules(
    trades: DataFrame, fixflows: DataFrame, *, cap: int = K.LIST_CAP, by_trade: bool = False
) -> DataFrame:
    """Notional list and frequencies per (trade, day), where there are any.

    All joins in here are between narrow rows; the wide trades then need one
    join for both results.
    """
    copies, found = trade_copies(trades).alias("c"), flow_frequencies(fixflows).alias("f")
    same_trade = (F.col("c.NB") == F.col("f.NB")) & (F.col("c.DAY") == F.col("f.DAY"))
    return (
        copies.join(found, same_trade & (F.col("STEP_COPIES") > 0), "left")
        .select("c.NB", "c.DAY", *_frequency_fields())
        .join(notionals(trades, fixflows, cap=cap, by_trade=by_trade), "NB", "left")
        .where(F.coalesce("QTY_FREQUENCY_LEG_1", "QTY_FREQUENCY_LEG_2", "CONCAT_CAPREM0").isNotNull())
    )
