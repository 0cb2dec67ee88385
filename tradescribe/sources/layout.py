"""How the three tables can be stored so that a report reads and shuffles less of them.

By value date, a run for some dates reads their folders only.  Number parts
below the dates let a list of trades read only the folders that can hold them.
Buckets of trade numbers let a report join the flows where they lie.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradescribe.sources.tables import trade_numbers

# The column of number parts tells how many there are, as in NB_PART_64.
_PART = re.compile(r"NB_PART_([1-9][0-9]*)")

# A filter that keeps every date there is; the optimizer prunes folders only by filtered tables.
_FIRST_DAY = "0001-01-01"


def number_part(number: Column, parts: int) -> Column:
    """The part of a trade number, blanks around it left out."""
    return F.pmod(F.hash(F.trim(number)), F.lit(parts))


def write_by_value_date(df: DataFrame, path: str, date_column: str, parts: int | None = None) -> None:
    """Lay a table out by value date, the key that all joins share, and with ``parts`` by parts of its trade numbers.

    A later run for some dates reads only their folders, and one for a list of
    trades only the parts of these.
    """
    folders = [date_column]
    if parts is not None:
        folders.append(f"NB_PART_{parts}")
        df = df.withColumn(folders[1], number_part(F.col("NB").cast("string"), parts)).repartition(*folders)
    df.write.mode("errorifexists").partitionBy(*folders).parquet(path)


def write_by_trade(df: DataFrame, table: str, path: str, buckets: int) -> None:
    """Store a table of the catalog in buckets of trade numbers, sorted inside; each bucket becomes one file.

    A report with ``by_trade`` joins such tables without a shuffle of the flows.
    All flows of a trade lie in one bucket, so this is for tables without a
    trade that outgrows a task; others are better left to the shuffle, which splits them.
    """
    df.repartition(buckets, "NB").write.mode("errorifexists").bucketBy(buckets, "NB").sortBy("NB").option(
        "path", path
    ).saveAsTable(table)


def on_dates(df: DataFrame, column: str, as_of: date | DataFrame | None) -> DataFrame:
    """The rows of one value date, or of the dates in the first column of a DataFrame; repeated and null dates do no harm.

    The dates are told to all executors (there are 3.7 million dates at most),
    which prunes the folders of a table laid out by date while it runs.
    """
    if as_of is None:
        return df
    if isinstance(as_of, date):
        return df.where(F.col(column) == F.lit(as_of))
    days = as_of.select(F.col(f"`{as_of.columns[0]}`").cast("date").alias("AS_OF_DAY"))
    days = days.where(F.col("AS_OF_DAY") >= F.lit(_FIRST_DAY).cast("date")).distinct()
    return df.join(F.broadcast(days), F.col(column) == F.col("AS_OF_DAY"), "left_semi")


def in_parts_of(df: DataFrame, allow_list: DataFrame | None) -> DataFrame:
    """The rows in the number parts of a list of trades; all rows of a table that has no parts.

    There are as many parts as the table's column says, so they can be told to
    all executors, however long the list is.
    """
    found = [(name, int(match[1])) for name in df.columns if (match := _PART.fullmatch(name))]
    if allow_list is None or not found:
        return df
    name, parts = found[0]
    wanted = trade_numbers(allow_list).select(number_part(F.col("NB"), parts).alias("WANTED_PART"))
    wanted = wanted.where(F.col("WANTED_PART") >= 0).distinct()
    return df.join(F.broadcast(wanted), F.col(name) == F.col("WANTED_PART"), "left_semi")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share, as spark.checkpoint.dir names it.

    Only a local master may go without the setting.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tradescribe-")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
