"""Quality rules as a learned decision list.

Statistics of each text are computed once.  From labelled statistics, sequential
covering learns rules for the documents to drop: a rule is grown condition by
condition on two thirds of the sample, by information gain, pruned on the other
third, and kept if it is precise there; what it covers is set aside, and the next
rule is learned.  The list is emitted as one ordered Spark conditional expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tradescribe.llm.tables import ship_package, stored
from tradescribe.llm.words import gram_hashes, text_slices, within_texts, word_hashes, words_of

WINDOW_WORDS = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of the words

# Labelled rows the list is learned from, at most; chosen by a hash of doc_id.
SAMPLE = 20_000

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
COUNTS = (*BASE, "n_lines", "n_distinct_words", "n_capitals", "n_digits", "n_marks", "n_letters", "n_bytes")

_MARKS = np.zeros(256, dtype=bool)
_MARKS[list(b".,;:!?\"'()-")] = True
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_CAPITALS = np.zeros(256, dtype=bool)
_CAPITALS[65:91] = True
_DIGITS = np.zeros(256, dtype=bool)
_DIGITS[48:58] = True
_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _sums(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _distinct(texts: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """How many distinct hashes each text has."""
    order = np.lexsort((hashes, texts))
    texts, hashes = texts[order], hashes[order]
    new = np.ones(len(texts), dtype=bool)
    new[1:] = (texts[1:] != texts[:-1]) | (hashes[1:] != hashes[:-1])
    return np.bincount(texts[new], minlength=n)


def text_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """COUNTS of each text of a slice."""
    n = len(offsets) - 1
    starts, ends, first = words_of(data, offsets)
    hashes = word_hashes(data, starts, ends)
    word_text = np.repeat(np.arange(n), np.diff(first))
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    in_word = np.cumsum(inside[:-1]) > 0

    # The line of each word, from a line feed or the text's start to the next one or the text's end.
    feeds = np.concatenate([[-1], np.flatnonzero(data == 10), [len(data)]])
    line = np.searchsorted(feeds, starts)
    line_starts, chosen = np.unique(np.maximum(feeds[line - 1] + 1, offsets[word_text]), return_index=True)
    line_text = word_text[chosen]
    line_ends = np.minimum(feeds[line[chosen]], offsets[line_text + 1])
    lines = np.bincount(line_text, minlength=n)

    at, owner = within_texts(first, WINDOW_WORDS)
    windows = gram_hashes(hashes, WINDOW_WORDS)[at] if len(at) else np.zeros(0, np.uint64)
    order = np.lexsort((windows, owner))
    same = np.zeros(len(at), dtype=bool)
    if len(at):
        equal = (windows[order][1:] == windows[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        same[order[1:][equal]] = True
        same[order[:-1][equal]] = True
    cover = np.zeros(len(starts) + WINDOW_WORDS + 1, dtype=np.int64)
    np.add.at(cover, at[same], 1)
    np.add.at(cover, at[same] + WINDOW_WORDS, -1)
    repeated = np.cumsum(cover)[: len(starts)] > 0

    return {
        "n_words": np.diff(first),
        "word_chars": _sums(in_word & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _sums(_SYMBOLS[data], offsets),
        "n_dup_lines": lines - _distinct(line_text, word_hashes(data, line_starts, line_ends), n),
        "n_repeat_words": np.bincount(word_text[repeated], minlength=n),
        "n_lines": lines,
        "n_distinct_words": _distinct(word_text, hashes, n),
        "n_capitals": _sums(_CAPITALS[data], offsets),
        "n_digits": _sums(_DIGITS[data], offsets),
        "n_marks": _sums(_MARKS[data], offsets),
        "n_letters": _sums(_LETTERS[data], offsets),
        "n_bytes": np.diff(offsets),
    }


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offsets in text_slices(batch["text"]):
            counts = text_counts(data, offsets)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch["doc_id"].slice(a, b - a), **{k: pa.array(v.astype(np.int64)) for k, v in counts.items()}}
            )


def text_statistics(documents: DataFrame) -> DataFrame:
    """doc_id and COUNTS of each document; a null text has none of anything."""
    ship_package(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(_counted, "doc_id long, " + ", ".join(f"{name} long" for name in COUNTS))


def features() -> dict[str, Column]:
    """What rules compare with thresholds."""
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "duplicate_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "distinct_words": share("n_distinct_words", "n_words"),
        "capitals": share("n_capitals", "n_letters"),
        "digits": share("n_digits", "n_bytes"),
        "marks_per_word": share("n_marks", "n_words"),
        "letters": share("n_letters", "n_bytes"),
        "words_per_line": share("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # at or above the threshold, else below it
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value >= F.lit(self.threshold) if self.above else value < F.lit(self.threshold)

    def holds(self, values: np.ndarray) -> np.ndarray:
        return values >= self.threshold if self.above else values < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, table: dict[str, np.ndarray], n: int) -> np.ndarray:
    covered = np.ones(n, dtype=bool)
    for condition in rule:
        covered &= condition.holds(table[condition.feature])
    return covered


def _grow(table: dict[str, np.ndarray], bad: np.ndarray, thresholds: dict[str, np.ndarray], most: int) -> Rule:
    rule: Rule = ()
    covered = np.ones(len(bad), dtype=bool)
    while len(rule) < most:
        p, n = int((covered & bad).sum()), int((covered & ~bad).sum())
        if not p or not n:
            break
        best, gain = None, 1e-9
        base = np.log2(p / (p + n))
        for name, cuts in thresholds.items():
            values = table[name][covered]
            bins = np.searchsorted(cuts, values, side="right")
            good_at = np.bincount(bins[~bad[covered]], minlength=len(cuts) + 1)
            bad_at = np.bincount(bins[bad[covered]], minlength=len(cuts) + 1)
            bad_below, good_below = np.cumsum(bad_at)[:-1], np.cumsum(good_at)[:-1]
            for above, p1, n1 in ((False, bad_below, good_below), (True, p - bad_below, n - good_below)):
                gains = np.where(p1 > 0, p1 * (np.log2(np.maximum(p1, 1) / np.maximum(p1 + n1, 1)) - base), 0)
                k = int(np.argmax(gains)) if len(gains) else 0
                if len(gains) and gains[k] > gain:
                    best, gain = Condition(name, above, float(cuts[k])), float(gains[k])
        if best is None:
            break
        rule = (*rule, best)
        covered &= best.holds(table[best.feature])
    return rule


def learn_list(
    table: dict[str, np.ndarray], bad: np.ndarray, rules: int = 12, conditions: int = 4, precision: float = 0.8, cuts: int = 64
) -> list[Rule]:
    """Ordered rules for bad rows; every third row, by place, is kept for pruning."""
    table = {name: np.asarray(values, dtype=np.float64) for name, values in table.items()}
    prune_row = np.arange(len(bad)) % 3 == 2
    left = np.ones(len(bad), dtype=bool)
    found: list[Rule] = []
    quantiles = np.linspace(0, 1, cuts + 1)[1:]
    while len(found) < rules and (left & bad).any():
        grow, prune = left & ~prune_row, left & prune_row
        if not (grow & bad).any():
            break
        part = {name: values[grow] for name, values in table.items()}
        # Cuts where the bad rows lie as well as where all rows lie.
        thresholds = {
            name: np.unique(np.concatenate([np.quantile(values, quantiles), np.quantile(values[bad[grow]], quantiles)]))
            for name, values in part.items()
        }
        rule = _grow(part, bad[grow], thresholds, conditions)
        held = {name: values[prune] for name, values in table.items()}
        worth = -2.0
        best: Rule = ()
        for k in range(len(rule), 0, -1):
            covered = _covers(rule[:k], held, int(prune.sum()))
            p, n = int((covered & bad[prune]).sum()), int((covered & ~bad[prune]).sum())
            if p + n and (p - n) / (p + n) >= worth:
                best, worth = rule[:k], (p - n) / (p + n)
        covered = _covers(best, table, len(bad)) & left if best else np.zeros(len(bad), dtype=bool)
        p, n = int((covered & bad).sum()), int((covered & ~bad).sum())
        if not best or p < 3 or (worth + 1) / 2 < precision or p < precision * (p + n):
            break
        found.append(best)
        left &= ~covered
    return found


def dropped_by(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, from 1; null where none does."""
    out = None
    for k, rule in enumerate(rules, 1):
        holds = F.lit(True)
        for condition in rule:
            holds = holds & condition.column()
        out = F.when(holds, F.lit(k)) if out is None else out.when(holds, F.lit(k))
    return F.lit(None).cast("int") if out is None else out


def quality_rules(statistics: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """Learn the list from the documents that have a label quality of 0 (bad) or 1.

    statistics should be a stored table.  At most `sample` documents are used, the
    first by a hash of doc_id; one that repeats counts once, as bad if it is
    labelled so, with its least statistics.  Without labels, the list is empty.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("_quality"))
    known = known.where(F.col("_quality").isin(0, 1)).groupBy("doc_id").agg(F.min("_quality").cast("int").alias("_quality"))
    one = F.struct(F.col("_quality").alias("quality"), *[c.alias(name) for name, c in features().items()])
    rows = (
        statistics.join(known, "doc_id")
        .groupBy("doc_id")
        .agg(F.min(one).alias("row"))
        .select("doc_id", "row.*")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
        .toArrow()
    )
    table = {name: rows[name].to_numpy() for name in features()}
    return learn_list(table, rows["quality"].to_numpy() == 0)


def judged(statistics: DataFrame, rules: list[Rule]) -> DataFrame:
    """Statistics with base_failed, kept and the number of the rule that drops a document."""
    base_failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rule = dropped_by(rules)
    return statistics.withColumns(
        {"base_failed": base_failed, "kept": ~base_failed & rule.isNull(), "rule": rule}
    )


def quality(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Each document's verdict: doc_id, the counts of BASE, base_failed, kept, rule.

    A null or empty text has no words and fails the base rules.  Repeated rows
    give a row each; a label of a missing document, a null label and other
    columns are not used; an empty table gives no rows.
    """
    statistics = stored(text_statistics(documents), "quality-statistics")
    rows = judged(statistics, quality_rules(statistics, labels, sample))
    return rows.select("doc_id", *BASE, "base_failed", "kept", "rule")
