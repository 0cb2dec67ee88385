"""The field-investigation extract as CSV: header, commas, no quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tradescribe.functions.numbers import text_number
from tradescribe.sources import schemas as S

REJECTED_LINE, REASON = "REJECTED_LINE", "REASON"


def read_extract(spark: SparkSession, path: str) -> DataFrame:
    """Read an extract; blank padding is kept and an empty field is NULL."""
    return (
        spark.read.schema(S.EXTRACT)
        .option("header", True)
        .option("enforceSchema", False)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def checked_extract(spark: SparkSession, path: str) -> DataFrame:
    """Every line of an extract: the columns of a good one, or the line as it stands and why it is rejected.

    A good line has as many fields as the header and a number in its first one.
    Empty lines are no lines.  A file with another header is an error.
    """
    schema = T.StructType([*S.EXTRACT, T.StructField(REJECTED_LINE, S.TEXT)])
    read = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECTED_LINE)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    number = text_number_or_null(F.col("NB"))
    reason = F.when(F.col(REJECTED_LINE).isNotNull(), "fields").when(number.isNull(), "number")
    line = F.coalesce(REJECTED_LINE, F.concat_ws(",", *[F.coalesce(f.name, F.lit("")) for f in S.EXTRACT]))
    return read.select(
        *[F.when(reason.isNull(), F.col(f.name)).alias(f.name) for f in S.EXTRACT],
        F.when(reason.isNotNull(), line).alias(REJECTED_LINE),
        reason.alias(REASON),
    )


def text_number_or_null(text: Column) -> Column:
    """Whole numbers only; anything else, blanks and NULL included, is NULL."""
    return F.when(text.rlike("^ *[0-9]+ *$"), text_number(F.trim(text)))


def accepted(checked: DataFrame) -> DataFrame:
    """The good lines of a checked extract."""
    return checked.where(F.col(REASON).isNull()).select(*[f.name for f in S.EXTRACT])


def rejected(checked: DataFrame) -> DataFrame:
    """The other lines and why."""
    return checked.where(F.col(REASON).isNotNull()).select(REJECTED_LINE, REASON)


def write_extract(extract: DataFrame, path: str) -> None:
    """Write an extract, with the columns it has, as CSV files; the default ones ``read_extract`` reads back unchanged."""
    (
        extract.write.mode("errorifexists")
        .option("header", True)
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
