"""Number formatting, on decimals only.

A decimal's own text form can be scientific (``0E-12``), depending on the
session, so digits are taken from the integer part and from ``1 + fraction``,
whose text forms never are.  Changing the sign of a decimal of more than 34
digits rounds it, so the sign is taken off the text instead.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tradescribe import constants as K


def _parts(number: Column) -> tuple[Column, Column, Column]:
    """Sign, integer digits (empty for zero) and the 12 decimals, all text."""
    negative = number < 0
    whole = F.when(negative, F.ceil(number)).otherwise(F.floor(number)).cast("decimal(38,0)")
    rest = (number % F.lit(1)).cast("decimal(13,12)")
    beyond_one = F.when(negative, F.lit(1) - rest).otherwise(F.lit(1) + rest).cast("decimal(13,12)")
    sign = F.when(negative, "-").otherwise("")
    digits = F.when(whole == 0, "").otherwise(F.translate(whole.cast("string"), "-", ""))
    decimals = F.substring(beyond_one.cast("string"), 3, K.AMOUNT_DECIMALS)
    return sign, digits, decimals


def number_text(number: Column) -> Column:
    """Shortest plain form: no trailing zeros, no zero before the point."""
    sign, digits, decimals = _parts(number)
    kept = F.rtrim(decimals, F.lit("0"))
    body = F.when(kept == "", F.when(digits == "", "0").otherwise(digits)).otherwise(
        F.concat(digits, F.lit("."), kept)
    )
    return F.when(number.isNotNull(), F.concat(sign, body))


def amount_text(number: Column) -> Column:
    """Rounded to cents, 12 decimals, zero-filled to the field width.

    The zeros go before the sign, and a number of more than 26 integer digits
    becomes a row of ``#``, as in the source database.
    """
    rounded = F.round(number, 2)
    sign, digits, decimals = _parts(rounded)
    text = F.lpad(F.concat(sign, digits, F.lit("."), decimals), K.AMOUNT_WIDTH, "0")
    too_big = F.length(digits) > K.AMOUNT_INTEGER_DIGITS
    return F.when(too_big, "#" * K.AMOUNT_WIDTH).when(rounded.isNotNull(), text)


def _or_error(value: Column, given: Column, message: str) -> Column:
    """The value; an error, in every session, where it is missing for something given."""
    failed = F.raise_error(F.concat(F.lit(message), given.cast("string"))).cast("decimal(38,0)")
    return F.when(given.isNotNull() & value.isNull(), failed).otherwise(value)


def text_number(text: Column) -> Column:
    """Numeric value of an all-digit identifier; any other text is an error."""
    return _or_error(text.try_cast("decimal(38,0)"), text, "not a number: ")


def whole_number_text(number: Column) -> Column:
    """Text of an identifier that comes as a number of any type; a fraction is an error."""
    whole = number.try_cast("decimal(38,0)")
    kept = F.when(whole == number, whole)
    return _or_error(kept, number, "not a whole number: ").cast("string")
