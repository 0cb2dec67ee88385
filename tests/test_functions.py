"""Dialect functions on single values."""

from __future__ import annotations

import decimal
from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tradescribe.functions import dates, numbers, rules, rows, text
from tradescribe.operators import classify, packages, units
from tradescribe.operators.schedule import cut_list, elements_that_fit


def value(spark, expression, kind="string", given=None):
    return spark.range(1).select(expression(F.lit(given).cast(kind))).first()[0]


@pytest.mark.parametrize(
    "given, expected",
    [("  a b ", "a b"), ("   ", None), ("", None), (None, None), ("\ta ", "\ta")],
)
def test_trimmed(spark, given, expected):
    assert value(spark, text.trimmed, given=given) == expected


@pytest.mark.parametrize("given, expected", [("abC", "C"), ("", None), (None, None), ("x", "x")])
def test_last_char(spark, given, expected):
    assert value(spark, text.last_char, given=given) == expected


@pytest.mark.parametrize("given, expected", [("n", "own-n"), (None, "own-"), ("", "own-")])
def test_joined(spark, given, expected):
    assert value(spark, lambda x: text.joined(F.lit("own-"), x), given=given) == expected


def test_joined_of_nothing(spark):
    assert value(spark, lambda x: text.joined(x, x)) is None


ODD_TEXTS = [None, "a", "ab", "a\x00", "a\x00b", "\x00", "\x01", "\x01\x02", "\x01\x03", "\x00\x03", "\x01\x00", "日本", "b|c", "x" * 50]


def test_packed_texts_come_out_again_and_keep_their_order(spark):
    rows = [(x, y, z) for x in ODD_TEXTS for y in ODD_TEXTS for z in (None, "z")]
    df = spark.createDataFrame(rows, "x string, y string, z string").select(
        "*", text.packed(F.col("x"), F.col("y"), F.col("z")).alias("p"), F.struct("x", "y", "z").alias("s")
    )
    out = text.with_unpacked(df, "p", ["a", "b", "c"]).select("x", "y", "z", "a", "b", "c").collect()
    assert len(out) == len(rows) and all(tuple(r)[:3] == tuple(r)[3:] for r in out)
    assert [r.s for r in df.orderBy("p").collect()] == [r.s for r in df.orderBy("s").collect()]
    none = spark.range(1).select(F.lit(None).cast("string").alias("p"))
    assert tuple(text.with_unpacked(none, "p", ["a", "b"]).first()) == (None, None)


def test_packs_are_cut_chained_and_filled(spark):
    one = text.packed(*map(F.lit, ["1", "2", "3"]))
    rows = spark.range(1).select(
        text.chained_packs(text.first_packs(one, 2), text.last_packs(one, 1)).alias("whole"),
        text.packs_filled(text.packed(F.lit(None).cast("string"), F.lit("b")), text.packed(F.lit("c"), F.lit("d")), 2).alias("filled"),
        text.packs_filled(F.lit(None).cast("string"), one, 3).alias("other"),
        one.alias("one"),
    )
    row = rows.first()
    assert row.whole == row.one == row.other and row.filled == "c\x00b"


def test_lookup_and_first_match(spark):
    table = {"a": "1", "b": "2"}
    assert value(spark, lambda x: rules.lookup(x, table, "other"), given="b") == "2"
    assert value(spark, lambda x: rules.lookup(x, table, "other")) == "other"
    unknown_first = [(F.lit(None).cast("boolean"), "unknown"), (F.lit(True), "yes")]
    assert value(spark, lambda x: rules.first_match(unknown_first)) == "yes"


NUMBER_TEXTS = [
    ("0.5", ".5"),
    ("-0.25", "-.25"),
    ("1000000", "1000000"),
    ("12.340", "12.34"),
    ("0", "0"),
    ("100", "100"),
    ("0.000000000001", ".000000000001"),
    ("-99999999999999999999999999.999999999999", "-99999999999999999999999999.999999999999"),
    (None, None),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_number_text(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        data = [(x,) for x, _ in NUMBER_TEXTS]
        number = F.col("x").cast("decimal(38,12)")
        got = spark.createDataFrame(data, "x string").select(numbers.number_text(number)).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert [row[0] for row in got] == [expected for _, expected in NUMBER_TEXTS]


def plain_amount(x: Decimal) -> str:
    cents = x.quantize(Decimal("0.01"), ROUND_HALF_UP)
    whole, _, part = f"{abs(cents):f}".partition(".")
    if len(whole) > 26:
        return "#" * 39
    sign = "-" if cents < 0 else ""
    return (sign + ("" if whole == "0" else whole) + "." + part.ljust(12, "0")).rjust(39, "0")[:39]


def plain_number(x: Decimal) -> str:
    shown = f"{x:f}"
    shown = shown.rstrip("0").rstrip(".") if "." in shown else shown
    sign, body = ("-", shown[1:]) if shown.startswith("-") else ("", shown)
    return sign + (body[1:] if body.startswith("0.") else body)


def twelve_decimals(n: int) -> str:
    whole, part = divmod(abs(n), 10**12)
    return f"{'-' if n < 0 else ''}{whole}.{part:012d}"


AMOUNTS = st.integers(-(10**38) + 1, 10**38 - 1).map(twelve_decimals)
SMALL = st.integers(-(10**15), 10**15).map(twelve_decimals)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(AMOUNTS, SMALL), min_size=40, max_size=60))
def test_number_formats_match_decimal_arithmetic(spark, amounts):
    data = [*amounts, "1.005", "-0.005", "-0.001", "0", "99999999999999999999999999.995"]
    number = F.col("x").cast("decimal(38,12)")
    got = (
        spark.createDataFrame([(x,) for x in data], "x string")
        .select("x", numbers.amount_text(number), numbers.number_text(number))
        .collect()
    )
    with decimal.localcontext(decimal.Context(prec=60)):
        for x, amount, shown in got:
            assert amount == plain_amount(Decimal(x)), x
            assert shown == plain_number(Decimal(x)), x


def test_amount_width(spark):
    assert value(spark, numbers.amount_text, "decimal(38,12)", Decimal("0.5")) == "0" * 26 + ".500000000000"
    assert value(spark, numbers.amount_text, "decimal(38,12)") is None


@pytest.mark.parametrize(
    "day, months, expected",
    [
        (date(2023, 2, 28), 12, date(2024, 2, 29)),
        (date(2023, 2, 28), 60, date(2028, 2, 29)),
        (date(2024, 2, 29), 12, date(2025, 2, 28)),
        (date(2024, 1, 31), 1, date(2024, 2, 29)),
        (date(2024, 6, 30), 1, date(2024, 7, 31)),
        (date(2024, 6, 15), 60, date(2029, 6, 15)),
        (None, 60, None),
    ],
)
def test_add_months(spark, day, months, expected):
    assert value(spark, lambda x: dates.add_months(x, months), "date", day) == expected


def test_months_and_days_between(spark):
    def apart(function, later, earlier):
        return value(spark, lambda x: function(F.lit(later), x), "date", earlier)

    assert apart(dates.months_between, date(2024, 2, 29), date(2024, 1, 31)) == 1
    assert apart(dates.months_between, date(2024, 3, 15), date(2024, 1, 15)) == 2
    assert apart(dates.months_between, date(2024, 2, 16), date(2024, 1, 31)) == pytest.approx(1 - 15 / 31)
    assert apart(dates.days_between, date(2024, 3, 1), date(2024, 2, 28)) == 2


@pytest.mark.parametrize(
    "given, cap, expected",
    [
        ("aaa,bbb,ccc,ddd,eee", 15, "aaa,bbb,ccc,..."),
        ("aaa,bbb,ccc,ddd,eee", 18, "aaa,bbb,ccc,..."),
        ("aaa,bbb,ccc,ddd,eee", 19, "aaa,bbb,ccc,ddd,eee"),
        ("aaaaaaaa,bbb", 8, "..."),
        ("aaa", 3, "aaa"),
        (None, 3, None),
    ],
)
def test_cut_list(spark, given, cap, expected):
    assert value(spark, lambda x: cut_list(x, cap), given=given) == expected


@pytest.mark.parametrize("cap", range(1, 12))
def test_kept_elements_overflow_any_cap(cap):
    assert len(",".join("x" * elements_that_fit(cap))) > cap


def test_repeat_rows(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 10_000), ("d", 25_001)], "k string, n bigint")
    got = rows.repeat_rows(df, "n", "i").groupBy("k", "n").agg(
        F.count("*").alias("rows"), F.count_distinct("i").alias("numbers"), F.max("i").alias("last")
    )
    for row in got.collect():
        assert row["rows"] == row["numbers"] == row["last"] == row["n"]


def test_padded_codes_switch(spark):
    df = spark.createDataFrame(
        [("CURR", "D", None, None, None, None, None, None, None)],
        "TRN_FMLY string, H_DVCS string, M_CFI string, H_PRODUCT string, C_CUR_PL string, TP_RTCUR0 string,"
        " TRN_GRP string, M_TP_MSTRUCT string, M_TP_CRISDA string",
    )
    assert df.select(classify.delivery_type()).first()[0] == "PHYS"
    assert df.select(classify.delivery_type(padded_codes_match=False)).first()[0] is None


@pytest.mark.parametrize(
    "path, kind, leg_1, leg_2",
    [
        ("Commodity:Agricultural:Softs:Fwd", None, "BUSL", "OTHR"),
        ("Commodity:Agricultural:GrainsOilseeds:Fwd", None, "BUSL", "BUSL"),
        ("COMMODITY:ENERGY:OIL:SWAP", None, "OTHR", "BARL"),
        ("InterestRate:Option:Swaption", "SWAP", "ACCY", "ACCY"),
        ("InterestRate:Option:Swaption", None, "ACCY", None),
        (None, None, "OTHR", None),
    ],
)
def test_units(spark, path, kind, leg_1, leg_2):
    df = spark.createDataFrame([(path, kind)], "HS_UPI string, TRN_TYPE string")
    assert tuple(df.select(units.unit_leg_1(), units.unit_leg_2()).first()) == (leg_1, leg_2)


def test_unknown_package_kind_counts_for_both_notations(spark):
    df = spark.createDataFrame(
        [("TRUE", None, "Basis points"), ("FALSE", None, "Decimal"), ("TRUE", "Spread", "Decimal")],
        "PACKAGE_INDICATOR string, M_PKG_TYP_R string, M_PKG_NOTA_R string",
    )
    got = df.select(packages.price_notation(), packages.spread_notation()).collect()
    assert [tuple(row) for row in got] == [("EROR", "4"), (None, None), (None, "3")]
