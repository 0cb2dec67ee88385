"""The latest counterparty versions, kept up to date as new versions arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradescribe.sources.layout import on_dates
from tradescribe.sources.schemas import COUNTERPARTIES, COUNTERPARTY_ATTRIBUTES
from tradescribe.sources.tables import normal_counterparties


def version_snapshot(counterparties: DataFrame) -> DataFrame:
    """One version of each (code, date), the one that ``latest_versions`` picks, with its creation time.

    It has the columns of the source, so it can stand in for it in any report.
    """
    version = F.struct("SYS_CREAT_DTMS", *COUNTERPARTY_ATTRIBUTES)
    newest = (
        normal_counterparties(counterparties)
        .where(F.col("MUREX_COUNTERPART").isNotNull() & F.col("RPY_VALUE_DATE").isNotNull())
        .groupBy("MUREX_COUNTERPART", "RPY_VALUE_DATE")
        .agg(F.max(version).alias("version"))
    )
    kept = ("MUREX_COUNTERPART", "RPY_VALUE_DATE")
    return newest.select(*[F.col(f.name if f.name in kept else f"version.{f.name}").alias(f.name) for f in COUNTERPARTIES])


def updated_snapshot(snapshot: DataFrame, increment: DataFrame) -> DataFrame:
    """The snapshot of all versions seen so far, from the last one and the versions that came since.

    The greatest of some greatest versions is the greatest of all, so versions
    may come in any order, late or twice, and ties fall as in the full run.
    """
    return version_snapshot(normal_counterparties(snapshot).unionByName(normal_counterparties(increment)))


def updated_dates(snapshot: DataFrame, increment: DataFrame) -> DataFrame:
    """The same for the value dates of the increment only.

    On a snapshot laid out by value date, the other folders are neither read
    nor need they be written again (``partitionOverwriteMode=dynamic``).
    """
    return updated_snapshot(on_dates(snapshot, "RPY_VALUE_DATE", increment.select("RPY_VALUE_DATE")), increment)
