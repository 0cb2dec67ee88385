"""Field investigation: the raw inputs behind one field, for suspect trades."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from tradescribe.operators.counterparty import matched_trades
from tradescribe.operators.trades import base_trades, on_list
from tradescribe.sources.layout import on_dates
from tradescribe.sources.schemas import EXTRACT_COLUMNS

_SOURCE = "SOURCE_"


def investigation_extract(
    trades: DataFrame,
    counterparties: DataFrame,
    suspects: DataFrame,
    columns: list[str] | None = None,
    *,
    as_of: date | DataFrame | None = None,
    allow_list: DataFrame | None = None,
) -> DataFrame:
    """Deciding inputs of the suspect trades (first column: trade number).

    The default columns are those that decide the payer of leg 1.  Trade columns
    come as the source has them, padding and empty text included; codes are
    compared in their normal form.  ``as_of`` and ``allow_list`` restrict the
    trades as in the report.  Suspects are selected before the counterparties
    are looked up, so only their codes are resolved.
    """
    wanted = columns or EXTRACT_COLUMNS
    raw = [name for name in wanted if name in trades.columns]
    counterparties = on_dates(counterparties, "RPY_VALUE_DATE", as_of)
    carried = trades.withColumn(_SOURCE, F.struct(*raw)) if raw else trades
    chosen = on_list(base_trades(carried, as_of=as_of, allow_list=allow_list, keep=(_SOURCE,) if raw else ()), suspects)
    return matched_trades(chosen, counterparties).select(
        *[F.col(_SOURCE).getField(name).alias(name) if name in raw else F.col(name) for name in wanted]
    )
