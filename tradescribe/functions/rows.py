"""Counted rows: pieces of bounded size, and back to single rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

PIECE = 10_000


def split_counts(df: DataFrame, count: str, first: str, last: str) -> DataFrame:
    """One row per piece of at most 10,000 of the ``count`` copies.

    ``first`` and ``last`` number the copies of the piece.  Pieces can be
    sorted or shuffled like rows, so that many copies spread over many tasks.
    """
    pieces = df.withColumn(first, F.explode(F.sequence(F.lit(1), F.col(count), F.lit(PIECE))))
    return pieces.withColumn(last, F.least(F.col(first) + F.lit(PIECE - 1), F.col(count)))


def expand_pieces(pieces: DataFrame, first: str, last: str, number: str) -> DataFrame:
    """Every copy of every piece, in order, with its number."""
    return pieces.withColumn(number, F.explode(F.sequence(F.col(first), F.col(last)))).drop(first, last)


def repeat_rows(df: DataFrame, count: str, number: str) -> DataFrame:
    """Each row ``count`` times, numbered from 1; no array grows with the count."""
    return expand_pieces(split_counts(df, count, "FIRST_", "LAST_"), "FIRST_", "LAST_", number)
