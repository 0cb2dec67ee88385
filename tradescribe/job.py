"""Command line: write a report, a sorted field list or an investigation extract.

    python -m tradescribe.job report  --trades T --counterparties C --fixflows F --out PATH
    python -m tradescribe.job fields  ... --fields BUYER_IDENTIFIER --out PATH
    python -m tradescribe.job extract ... --suspects PATH --out PATH

A table is a Parquet path (anything with a slash) or a catalog name.  A list of
trade numbers is such a table, or with --numbers-format a CSV file with a header
or a text file of one number a line; --numbers-column names its column.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradescribe import constants as K
from tradescribe.functions.numbers import text_number
from tradescribe.plans.consumer import field_list
from tradescribe.plans.investigate import investigation_extract
from tradescribe.plans.report import report
from tradescribe.session import tune
from tradescribe.sources import schemas as S
from tradescribe.sources.extract_csv import write_extract


def _load(spark: SparkSession, place: str, schema=None) -> DataFrame:
    if "/" not in place:
        return spark.table(place)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(place)


def _numbers(spark: SparkSession, place: str | None, kind: str, column: str | None) -> DataFrame | None:
    """Trade numbers from the named or first column; a value of a file that is no number is an error."""
    if place is None:
        return None
    if kind == "table":
        rows = _load(spark, place)
    elif kind == "csv":
        rows = spark.read.option("header", True).csv(place)
    else:
        rows = spark.read.text(place)
    numbers = rows.select(F.col(f"`{column or rows.columns[0]}`").alias("NB"))
    if kind == "table":
        return numbers
    text = F.trim("NB")
    return numbers.where(text != "").select(F.when(text_number(text).isNotNull(), text).alias("NB"))


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tradescribe", description=__doc__.splitlines()[0])
    parser.add_argument("job", choices=["report", "fields", "extract"])
    for table in ("trades", "counterparties", "fixflows"):
        parser.add_argument(f"--{table}", required=table != "fixflows")
    parser.add_argument("--out", required=True, help="folder to create")
    parser.add_argument("--as-of", type=date.fromisoformat, nargs="+", help="report these value dates")
    parser.add_argument("--by-trade", action="store_true", help="the flows lie in buckets of trade numbers")
    parser.add_argument("--allow-list", help="report only these trade numbers")
    parser.add_argument("--suspects", help="trade numbers to investigate")
    parser.add_argument("--numbers-format", choices=["table", "csv", "text"], default="table")
    parser.add_argument("--numbers-column", help="column of the trade numbers, else the first")
    parser.add_argument("--list-cap", type=int, default=K.LIST_CAP, help="bytes of a notional list; longer ones are cut")
    parser.add_argument("--own-lei", default=K.OWN_LEI, help="LEI of the reporting party")
    parser.add_argument("--fields", nargs="+", default=["BUYER_IDENTIFIER"], choices=S.REPORT_COLUMNS[1:])
    arguments = parser.parse_args(argv)
    if arguments.job == "extract" and not arguments.suspects:
        parser.error("extract needs --suspects")
    if arguments.job != "extract" and not arguments.fixflows:
        parser.error(f"{arguments.job} needs --fixflows")
    return arguments


def run(spark: SparkSession, argv: Sequence[str] | None = None) -> None:
    arguments = _arguments(argv)
    tune(spark, by_trade=arguments.by_trade)
    trades = _load(spark, arguments.trades, S.TRADES)
    counterparties = _load(spark, arguments.counterparties, S.COUNTERPARTIES)

    def numbers(place: str | None) -> DataFrame | None:
        return _numbers(spark, place, arguments.numbers_format, arguments.numbers_column)

    as_of = arguments.as_of
    if as_of is not None:
        as_of = as_of[0] if len(as_of) == 1 else spark.createDataFrame([(day,) for day in as_of], "day date")
    if arguments.job == "extract":
        extract = investigation_extract(
            trades, counterparties, numbers(arguments.suspects), as_of=as_of, allow_list=numbers(arguments.allow_list)
        )
        write_extract(extract, arguments.out)
        return
    inputs = trades, counterparties, _load(spark, arguments.fixflows, S.FIXFLOWS)
    options = {
        "as_of": as_of,
        "allow_list": numbers(arguments.allow_list),
        "own_lei": arguments.own_lei,
        "list_cap": arguments.list_cap,
        "by_trade": arguments.by_trade,
    }
    if arguments.job == "report":
        result = report(*inputs, **options, compact=True)
    else:
        result = field_list(*inputs, *arguments.fields, **options)
    result.write.mode("errorifexists").parquet(arguments.out)


if __name__ == "__main__":
    run(SparkSession.builder.appName("tradescribe").getOrCreate())
