"""Base trades and the optional restrictions on them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from tradescribe.sources.layout import in_parts_of, on_dates
from tradescribe.sources.tables import normal_trades, trade_numbers


def on_list(df: DataFrame, allow_list: DataFrame | None) -> DataFrame:
    """The rows whose trade number is on the list, if there is one; repeated numbers do no harm."""
    return df if allow_list is None else df.join(trade_numbers(allow_list), "NB", "left_semi")


def on_list_late(df: DataFrame, allow_list: DataFrame | None) -> DataFrame:
    """The same rows, by an inner join with the distinct numbers.

    The optimizer moves a semi join below all projections, to the raw columns;
    this one stays behind them and shuffles only what they leave.
    """
    return df if allow_list is None else df.join(trade_numbers(allow_list).distinct(), "NB")


def base_trades(
    trades: DataFrame,
    *,
    as_of: date | DataFrame | None = None,
    allow_list: DataFrame | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The trades to report, one row per input row.

    ``as_of`` keeps one value date, or the dates in a DataFrame's first column;
    on a table laid out by date it prunes folders.  ``allow_list`` is a DataFrame
    whose first column holds trade numbers; it prunes the number parts of a
    table that has them.  Columns ``keep`` of the source stay beside the trade columns.
    """
    kept = in_parts_of(on_dates(trades, "THD_VALUE_DATE", as_of), allow_list)
    return on_list(normal_trades(kept, keep), allow_list)
