"""Readers and the one place where raw text is normalised.

The source database treats an empty string as NULL and ignores the blank
padding of fixed-width columns.  Spark does neither, so both rules are applied
here, once, and no operator has to think about them again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tradescribe.functions.numbers import whole_number_text
from tradescribe.functions.text import empty_to_null
from tradescribe.sources import schemas as S


# Text columns that identify a row and may come as numbers.
_IDENTIFIERS = ("NB",)

# Start of a schedule step: the one date whose time of day counts.
_MOMENTS = ("DATE2",)


def _typed(found: T.DataType | None, field: T.StructField) -> Column:
    """A column in its declared type; trade numbers that are numbers lose no digit, moments no hour."""
    value = F.col(field.name)
    if found is None or found == field.dataType:
        return value
    if field.name in _IDENTIFIERS and isinstance(found, T.NumericType):
        return whole_number_text(value)
    if field.name in _MOMENTS and isinstance(found, (T.TimestampType, T.TimestampNTZType)):
        return value.cast(S.MOMENT)
    return value.cast(field.dataType)


def trade_numbers(df: DataFrame) -> DataFrame:
    """The first column as trade numbers: NB, text without blanks around it."""
    name = df.columns[0]
    field = T.StructField("NB", S.TEXT)
    renamed = df.select(F.col(f"`{name}`").alias("NB"))
    return renamed.select(F.trim(_typed(renamed.schema["NB"].dataType, field)).alias("NB"))


def _conform(
    df: DataFrame, schema: T.StructType, padded: tuple[str, ...] = (), keep: tuple[str, ...] = ()
) -> DataFrame:
    found = {field.name: field.dataType for field in df.schema}

    def column(field: T.StructField) -> Column:
        value = _typed(found.get(field.name), field)
        if field.name in padded:
            value = F.rtrim(value)
        return empty_to_null(value).alias(field.name) if field.dataType == S.TEXT else value.alias(field.name)

    return df.select(*[column(field) for field in schema], *keep)


def normal_trades(trades: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 65 trade columns with their declared types, empty text as NULL; columns ``keep`` come as they are."""
    return _conform(trades, S.TRADES, S.PADDED_COLUMNS, keep)


def normal_counterparties(counterparties: DataFrame) -> DataFrame:
    """The 18 counterparty columns, empty text as NULL."""
    return _conform(counterparties, S.COUNTERPARTIES)


def normal_fixflows(fixflows: DataFrame) -> DataFrame:
    """The 11 flow columns.

    Flow text is only compared with non-empty literals and trade numbers, where
    an empty string and NULL act alike; it stays as read, so that the flag
    filters reach the Parquet scan.
    """
    found = {field.name: field.dataType for field in fixflows.schema}
    return fixflows.select(*[_typed(found.get(field.name), field).alias(field.name) for field in S.FIXFLOWS])


def read_trades(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.TRADES).parquet(path)


def read_counterparties(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.COUNTERPARTIES).parquet(path)


def read_fixflows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.FIXFLOWS).parquet(path)
