"""Text rules of the source dialect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def empty_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def trimmed(text: Column) -> Column:
    """Blanks off both ends; a value of blanks only is NULL."""
    return empty_to_null(F.trim(text))


def folded(text: Column) -> Column:
    """Trimmed and in upper case, for comparing hand-typed codes."""
    return F.upper(trimmed(text))


def last_char(text: Column) -> Column:
    """Last character, NULL for NULL or empty text."""
    return empty_to_null(F.substring(text, -1, 1))


def joined(*parts: Column) -> Column:
    """Concatenation that reads NULL as empty; NULL when nothing is left."""
    return empty_to_null(F.concat(*[F.coalesce(part, F.lit("")) for part in parts]))


def mentions(text: Column, *words: str) -> Column:
    """Whether any word occurs in ``text``, case-sensitively; NULL for NULL text."""
    found = text.contains(words[0])
    for word in words[1:]:
        found = found | text.contains(word)
    return found


# Between packed texts, below any character; what stands for the characters 0 and 1 inside one.
_BETWEEN, _ZERO, _ONE = "\x00", "\x01\x02", "\x01\x03"


def _chained(pieces: list[Column]) -> Column:
    return F.concat(*[x for piece in pieces for x in (F.lit(_BETWEEN), piece)][1:])


def packed(*texts: Column) -> Column:
    """Texts in one, for shuffles: a row of many short columns is mostly offsets and padding.

    Whatever the texts hold comes out again; an empty text is NULL, as anywhere
    here.  Packs compare as structs of the texts do: one by one, NULL first.
    """
    marked = [F.replace(F.replace(text, F.lit("\x01"), F.lit(_ONE)), F.lit("\x00"), F.lit(_ZERO)) for text in texts]
    return _chained([F.coalesce(text, F.lit("")) for text in marked])


def with_unpacked(df: DataFrame, pack: str, names: list[str]) -> DataFrame:
    """The texts of a pack as columns in its place; all NULL for a NULL pack."""
    pieces = f"{pack}pieces"

    def text(number: int) -> Column:
        piece = F.get(F.col(pieces), F.lit(number))
        whole = F.replace(F.replace(piece, F.lit(_ZERO), F.lit("\x00")), F.lit(_ONE), F.lit("\x01"))
        return F.when(piece.contains("\x01"), whole).otherwise(empty_to_null(piece))

    # A step of its own, else every text would split the pack again.
    split = df.withColumn(pieces, F.split(pack, _BETWEEN, -1))
    return split.withColumns({name: text(number) for number, name in enumerate(names)}).drop(pack, pieces)


def first_packs(pack: Column, count: int) -> Column:
    """A pack of the first so many texts of a pack."""
    return F.substring_index(pack, _BETWEEN, count)


def last_packs(pack: Column, count: int) -> Column:
    """A pack of the last so many texts of a pack."""
    return F.substring_index(pack, _BETWEEN, -count)


def chained_packs(*packs: Column) -> Column:
    """One pack of the texts of some; NULL if one is."""
    return _chained(list(packs))


def packs_filled(pack: Column, other: Column, count: int) -> Column:
    """A pack with its NULLs filled from another of as many texts, one by one."""

    def given(each: Column, number: int) -> Column:
        return empty_to_null(F.get(F.split(each, _BETWEEN, -1), F.lit(number)))

    filled = _chained([F.coalesce(given(pack, i), given(other, i), F.lit("")) for i in range(count)])
    return F.when(pack.isNotNull() & other.isNotNull(), filled).otherwise(F.coalesce(pack, other))
