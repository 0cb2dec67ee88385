"""Intermediate tables in the shared folder, gapless numbers, and code for executors."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

_SHIPPED = "_tradescribe_shipped"

# Rows that go to Python at once: whole texts may be long, and each batch is in memory several times.  No result depends on it.
ARROW_ROWS = 2_000
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

# Bytes that go to Python at once where single rows may have megabytes, and one row more.  No result depends on it.
ARROW_BYTES = 4_000_000
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

# Option of a Parquet writer.
ROW_ALONE = {"parquet.block.row.count.limit": "1"}

# Seconds after which a Python worker that neither takes nor gives anything is ended and its task run again.  A batch
# takes a few seconds; no result depends on it.
SILENT_S = 240
_SILENT_S = "spark.sql.execution.pyspark.udf.idleTimeoutSeconds"
_END_SILENT = "spark.sql.execution.pyspark.udf.killOnIdleTimeout"


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once for each Spark application, and keep the session's batches small.

    One worker that stands still would hold up the whole job: it is ended after
    SILENT_S, for all of the session's Python functions.  A session with a limit
    of its own, or one in its application, keeps that.
    """
    if not 0 < int(spark.conf.get(_ARROW_ROWS)) <= ARROW_ROWS:
        spark.conf.set(_ARROW_ROWS, str(ARROW_ROWS))
    if re.fullmatch("0[a-z]*", spark.conf.get(_SILENT_S)):
        spark.conf.set(_SILENT_S, str(SILENT_S))
        spark.conf.set(_END_SILENT, "true")
    context = spark.sparkContext
    if getattr(context, _SHIPPED, False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp()
    archive = os.path.join(folder, "tradescribe_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for here, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(here, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(archive)
    setattr(context, _SHIPPED, True)


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """While it lasts, rows of megabytes go to Python one by one or a few at once, for the session's other functions too."""
    before = spark.conf.get(_ARROW_BYTES)
    spark.conf.set(_ARROW_BYTES, str(ARROW_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_ARROW_BYTES, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    The cluster names it in spark.checkpoint.dir.  Only where that is unset and
    the master is local, as in tests, a temporary folder takes its place.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tradescribe-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, alone: bool = False) -> DataFrame:
    """The same rows from a table in the shared folder.

    It cuts the lineage: a lost executor costs no more than the tasks it ran.
    With `alone`, for rows of megabytes, each is a row group: Spark's reader
    holds all rows of a group, up to 4,096, at once.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.options(**(ROW_ALONE if alone else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Give back to the system what earlier tasks of this Python worker freed.

    Workers are used again, and a model that an earlier stage has dropped would
    otherwise count beside what the next one needs.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(
    df: DataFrame, group: list[str], order: list[str], name: str, size: str | None = None, unique: bool = False
) -> DataFrame:
    """Add a gapless number from 0 within each group, in an order that depends on the rows alone.

    With `size`, the group's number of rows comes in a column of that name.

    A group may hold any share of the rows: it is dealt over buckets by a hash
    of the order columns, numbered within each bucket, and the sizes of the
    buckets before give the rest.  Rows equal in all order columns are counted
    before they are dealt, and so many copies of a row are one row here.  With
    `unique`, there are none, and the rows save that shuffle.

    df is read twice and should be a stored table.  Other columns than those
    given are dropped.  The buckets are as many as the shuffle partitions.
    """
    spark = df.sparkSession
    bucket = F.pmod(F.xxhash64(*order), F.lit(shuffle_partitions(spark))).cast("int")
    rows = df.select(*group, *order)
    counted = (
        rows.withColumn("_copies", F.lit(1).cast("long"))
        if unique
        else rows.groupBy(*group, *order).agg(F.count(F.lit(1)).alias("_copies"))
    ).withColumn("_bucket", bucket)
    sizes = df.groupBy(*group, bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(
        *group,
        "_bucket",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"),
        F.sum("_size").over(Window.partitionBy(*group)).alias("_total"),
    )
    inner = Window.partitionBy(*group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("_before", F.coalesce(F.sum("_copies").over(inner), F.lit(0)))
    same: Column | None = None
    for column in [*group, "_bucket"]:
        equal = F.col(f"p.{column}").eqNullSafe(F.col(f"b.{column}"))
        same = equal if same is None else same & equal
    start = F.col("b._base") + F.col("p._before")
    return placed.alias("p").join(bases.alias("b"), same).select(
        *[F.col(f"p.{c}").alias(c) for c in [*group, *order]],
        *([F.col("b._total").alias(size)] if size else []),
        F.explode(F.sequence(start, start + F.col("p._copies") - 1)).alias(name),
    )
