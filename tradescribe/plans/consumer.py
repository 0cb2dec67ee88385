"""Field list: chosen report fields per trade, sorted by trade number."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradescribe.functions.numbers import text_number
from tradescribe.functions.rows import expand_pieces, split_counts
from tradescribe.plans.report import report


def field_list(
    trades: DataFrame,
    counterparties: DataFrame,
    fixflows: DataFrame,
    *fields: str,
    **options,
) -> DataFrame:
    """``NB`` and ``fields``, in numeric order of ``NB``; a non-numeric one is an error.

    Only the tables behind the chosen fields are read.  Equal rows, which a
    trade with many snapshots has, are counted before they are sorted and
    written out again afterwards.  Large counts are sorted in pieces, so no
    task has to sort or write all rows of one trade number.  Counting also
    ends the join's stage: the sort's sampling pass does not join again.
    """
    rows = report(trades, counterparties, fixflows, **options).groupBy("NB", *fields).agg(
        F.count(F.lit(1)).alias("COPIES_")
    )
    pieces = split_counts(rows, "COPIES_", "FIRST_", "LAST_").orderBy(
        text_number(F.col("NB")).asc_nulls_last(), *fields, "FIRST_"
    )
    return expand_pieces(pieces, "FIRST_", "LAST_", "COPY_").select("NB", *fields)


def buyers(trades: DataFrame, counterparties: DataFrame, fixflows: DataFrame, **options) -> DataFrame:
    """Buyer per trade, sorted by trade number."""
    return field_list(trades, counterparties, fixflows, "BUYER_IDENTIFIER", **options)
