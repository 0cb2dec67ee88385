"""From raw documents to packed training sequences, in five stages.

Each stage takes what the one before kept, as a Parquet table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradescribe.llm.blob_ledger import masked
from tradescribe.llm.jaccard_join import one_of_each_group
from tradescribe.llm.pattern_packing import packed
from tradescribe.llm.subword_language import REJECT, UNKNOWN, in_training, language_model, with_language
from tradescribe.llm.tables import stored
from tradescribe.llm.toxicity_neighbours import THRESHOLD, fit, with_toxicity


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose nearest labelled examples are toxic.

    Without labels all stay.  A null or empty text scores as the examples without
    a word do; long texts are judged whole; repeated rows share their verdict; an
    empty table stays empty.
    """
    vocabulary, index = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    names = [f"_c{i}" for i in range(len(docs.columns))]
    scored = with_toxicity(docs, vocabulary, index, *docs.columns).toDF(*names, "_score", "_evidence")
    return scored.where(F.col("_score") < THRESHOLD).select(*names).toDF(*docs.columns)


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, and those whose language is too uncertain.

    If no document tells its language, nothing can be judged and all stay.  A null
    text has no letter; repeated rows share their verdict; an empty table stays empty.
    """
    model = language_model(docs.where(in_training()))
    if model is None:
        return docs
    names = [f"_c{i}" for i in range(len(docs.columns))]
    scored = with_language(docs, model, *docs.columns).toDF(*names, "_lang", "_score")
    known = (F.col("_lang") != UNKNOWN) & (F.col("_score") >= REJECT)
    return scored.where(known).select(*names).toDF(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies.

    Null and empty texts are near nothing and all stay; rows that repeat a
    document are its copies; an empty table stays empty.
    """
    return one_of_each_group(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask every secret.

    All rows stay, null texts as they are; an empty table stays empty.
    """
    return masked(docs)


def in_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents' tokens.

    A null or empty text is its end mark alone; long texts are cut into pieces;
    repeated rows are packed each; an empty table gives no pieces.
    """
    return packed(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("language", in_known_language),
    ("near_copies", without_near_copies),
    ("secrets", without_secrets),
    ("packing", in_sequences),
]

# The learned, iterative and token-based stages have no SQL form; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the pieces of the kept documents and their places in sequences."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
