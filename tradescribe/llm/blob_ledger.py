"""Secret scans with a ledger of contents already scanned.

Every version of every path is addressed by the digest of its content.  A scan
reads the ledger, scans each content that the current version of the rules has
not seen, once, appends what it found, and joins the findings back to all paths.
Copies, renames and reverted versions so cost a lookup.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from tradescribe.llm.tables import fresh_path, release_memory, ship_package, stored

# Up to so many unseen contents (64 bytes each) are told to all executors at once.
BROADCAST_BLOBS = 200_000


@dataclass(frozen=True)
class Rule:
    """One kind of secret: where it may begin, what must be in the text at all, and how long it must be."""

    kind: str
    pattern: str
    hints: tuple[str, ...]  # the lower-cased text holds one of these, or there is no match
    group: int = 0
    least: int = 0  # characters of the group
    ignore_case: bool = False


# Patterns are fixed values of the query's contract.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        ("passw", "secret", "token", "api"),
        group=2,
        least=12,
        ignore_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", ("akia",), least=18),
    Rule("hex", r"[0-9a-f]+", (), least=16),
)
MORE_RULES = (
    # The header, whole lines of base64 behind it, and the footer; never prose.
    Rule(
        "pem",
        r"-----BEGIN (?:[A-Z]+ ){0,4}PRIVATE KEY-----(?:\s{0,4}[A-Za-z0-9+/=]{16,}+(?=\s{0,4}\n|\r|-----|\Z))*+"
        r"(?:(?:\s{0,4}[A-Za-z0-9+/=]{1,15})?\s{0,4}-----END (?:[A-Z]+ ){0,4}PRIVATE KEY-----)?",
        ("private key-----",),
    ),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", ("eyj",)),
    Rule("bearer", r"[Bb]earer\x20+[A-Za-z0-9+/_.=-]{20,}", ("bearer",)),
    Rule("userinfo", r"(?<![a-z0-9+])[a-z][a-z0-9+]{0,31}://[^\s/:@]+:[^\s/:@]{6,}@", ("://",)),
)
RULES = BASE_RULES + MORE_RULES
BASE_KINDS = tuple(rule.kind for rule in BASE_RULES)

# A ledger's findings hold for these very rules: a changed pattern is another version.
RULES_VERSION = hashlib.sha256(repr(RULES).encode()).hexdigest()[:16]

FINDINGS = "blob string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
LEDGER = f"rules string, {FINDINGS}"

# The hex rule by its least length alone: a run of 16 or more is the run the rule matches.
_LONG_HEX = re.compile(r"[0-9a-f]{16,}")
_COMPILED = [
    (rule, re.compile(rule.pattern, re.ASCII | (re.IGNORECASE if rule.ignore_case else 0))) for rule in RULES
]


def spans_of(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every secret, in code points, by start and then kind as listed."""
    found = []
    lowered = text.lower()
    for place, (rule, pattern) in enumerate(_COMPILED):
        if rule.hints and not any(hint in lowered for hint in rule.hints):
            continue
        pattern = _LONG_HEX if rule.kind == "hex" else pattern
        for match in pattern.finditer(text):
            if match.end(rule.group) - match.start(rule.group) >= rule.least:
                found.append((match.start(), place, match.end(), rule.kind))
    return [(start, end, kind) for start, _, end, kind in sorted(found)]


def spans_text(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release_memory()
    for batch in batches:
        spans = [spans_of(text) for text in batch["content"].to_pylist()]
        base = [[span for span in row if span[2] in BASE_KINDS] for row in spans]
        yield pa.RecordBatch.from_pydict(
            {
                "blob": batch["blob"],
                **{
                    f"n_{kind}": pa.array([sum(span[2] == kind for span in row) for row in base], pa.int64())
                    for kind in BASE_KINDS
                },
                "base_sha256": pa.array([hashlib.sha256(spans_text(row).encode()).hexdigest() for row in base]),
                "spans": pa.array(map(spans_text, spans), pa.string()),
            }
        )


def blob_id(content: Column) -> Column:
    """The digest that addresses a content; null counts as empty."""
    return F.sha2(F.coalesce(content, F.lit("")).cast("binary"), 256)


def ledger_rows(spark, ledger: str) -> DataFrame:
    """The ledger's findings; an unwritten ledger is empty."""
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def scan_versions(versions: DataFrame, ledger: str, rules: str = RULES_VERSION) -> DataFrame:
    """Scan the contents the ledger has not seen under these rules, and return the findings of all of them.

    versions has a column content; ledger is a folder that the cluster shares.
    Returns FINDINGS once for each content ever scanned under these rules.
    Null contents count as empty; an empty table scans nothing.
    """
    spark = versions.sparkSession
    ship_package(spark)
    contents = versions.select(blob_id(F.col("content")).alias("blob"), F.coalesce("content", F.lit("")).alias("content"))
    seen = ledger_rows(spark, ledger).where(F.col("rules") == rules).select("blob").distinct()
    # Copies shrink to one in each map task before they meet.
    one_of_each = lambda rows: rows.groupBy("blob").agg(F.first("content").alias("content"))
    if seen.isEmpty():
        unseen = one_of_each(contents)
    else:
        fresh = stored(contents.select("blob").distinct().join(seen, "blob", "left_anti"), "blob-unseen")
        if fresh.count() <= BROADCAST_BLOBS:
            # Contents already scanned are not even shuffled.
            unseen = one_of_each(contents.join(F.broadcast(fresh), "blob", "left_semi"))
        else:
            unseen = one_of_each(contents).join(fresh, "blob", "left_semi")
    found = unseen.mapInArrow(_scan, FINDINGS)
    found.select(F.lit(rules).alias("rules"), "*").write.mode("append").parquet(ledger)
    # A repeated append, after a failure between two runs, changes no result.
    return ledger_rows(spark, ledger).where(F.col("rules") == rules).drop("rules").dropDuplicates(["blob"])


def secrets(documents: DataFrame, ledger: str | None = None, rules: str = RULES_VERSION) -> DataFrame:
    """Each document's secrets: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    spans lists kind:start:end of all secrets in code points, base_sha256 is the
    digest of that list for the three base kinds.  Without a ledger, a new one in
    the shared folder is used.  A null text counts as empty; repeated rows give
    a row each; other columns are not read; an empty table gives no rows.
    """
    spark = documents.sparkSession
    versions = documents.select(F.col("doc_id").cast("long"), F.col("text").alias("content"))
    found = stored(scan_versions(versions.select("content"), ledger or fresh_path(spark, "blob-ledger"), rules), "blob-findings")
    paths = stored(versions.select("doc_id", blob_id(F.col("content")).alias("blob")), "blob-paths")
    return paths.join(found, "blob").drop("blob")


MASK = "[secret]"


def masked(documents: DataFrame, ledger: str | None = None, rules: str = RULES_VERSION) -> DataFrame:
    """The documents with every secret's span replaced by a mask; all columns stay, n_chars follows the text."""
    spark = documents.sparkSession
    found = scan_versions(
        documents.select(F.col("text").alias("content")), ledger or fresh_path(spark, "blob-ledger"), rules
    )
    dirty = stored(found.where(F.col("spans") != "").select("blob", "spans"), "blob-dirty")

    @F.pandas_udf("string")
    def cover(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_covered(a, b) for a, b in zip(text, spans)], dtype=object)

    # The row stays one struct, so that its column names cannot clash with those of the findings.
    rows = documents.select(F.struct("*").alias("row"), blob_id(F.col("text")).alias("blob"))
    found_secrets = F.col("spans").isNotNull()
    out = rows.join(dirty, "blob", "left").withColumn(
        "clean", F.when(found_secrets, cover("row.text", "spans")).otherwise(F.col("row.text"))
    )
    columns = [F.col("row").getField(name).alias(name) for name in documents.columns]
    for i, name in enumerate(documents.columns):
        if name == "text":
            columns[i] = F.col("clean").alias(name)
        elif name == "n_chars":
            length = F.char_length("clean").cast(documents.schema[name].dataType)
            columns[i] = F.when(found_secrets, length).otherwise(F.col("row.n_chars")).alias(name)
    return out.select(*columns)


def _covered(text: str | None, spans: str | None) -> str | None:
    if not text or not spans:
        return text
    out, at = [], 0
    for item in spans.split(","):
        _, start, end = item.rsplit(":", 2)
        start, end = int(start), int(end)
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], MASK]
        at = end
    return "".join(out) + text[at:]
