"""Language of a text from averaged hashed subword embeddings (Joulin et al., 2017).

Subwords are the byte n-grams of the text with white space folded to one byte,
hashed to buckets.  A text is the mean of its buckets' embeddings, and a linear
softmax names the language.  Both layers are trained by stochastic gradient
descent in numpy on a bounded sample.  For prediction the two layers are one
table of scores by bucket, so a text costs a look-up for each of its subwords.
Probabilities are calibrated by a temperature on texts held back from training.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tradescribe.llm.tables import release_memory, ship_package, stored
from tradescribe.llm.words import _SEPARATOR, text_slices

BUCKETS = 1 << 14
NGRAMS = (2, 3, 4)
DIMENSIONS = 16
EPOCHS = 12
BATCH = 32
RATE = 0.5
SEED = 11

# Documents the model is fitted to, at most; chosen by a hash of their id and text.
SAMPLE = 2_500
# Languages that are learned, at most.
LANGUAGES = 256
# Every so-manieth document of the sample is kept for the temperature.
HELD_BACK = 5
# A text whose calibrated probability is lower is rejected.
REJECT = 0.5

UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[_SEPARATOR] = 32
_FOLD[48:58] = 48


def subword_buckets(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every subword of a slice, and the text it belongs to."""
    folded = _FOLD[data].astype(np.uint32)
    found, owners = [], []
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for n in NGRAMS:
        if len(folded) < n:
            continue
        key = np.zeros(len(folded) - n + 1, dtype=np.uint32)
        for i in range(n):
            key = key << np.uint32(8) | folded[i : len(folded) - n + 1 + i]
        bucket = (key * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(7)
        bucket ^= bucket >> np.uint32(11)
        inside = text[: len(key)] == text[n - 1 :]
        found.append((bucket % np.uint32(buckets))[inside].astype(np.int64))
        owners.append(text[: len(key)][inside])
    none = np.zeros(0, np.int64)
    return np.concatenate(found or [none]), np.concatenate(owners or [none])


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    scores: np.ndarray  # bucket by language
    bias: np.ndarray
    temperature: float

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Calibrated probabilities of each text of a slice."""
        n = len(offsets) - 1
        bucket, owner = subword_buckets(data, offsets, len(self.scores))
        counts = np.maximum(np.bincount(owner, minlength=n), 1)
        sums = np.stack(
            [np.bincount(owner, self.scores[bucket, k], minlength=n) for k in range(len(self.languages))], axis=1
        )
        return softmax((sums / counts[:, None] + self.bias) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, languages: tuple[str, ...], buckets: int = BUCKETS) -> LanguageModel:
    """Fit both layers; a row is a text's distinct buckets and their shares."""
    random = np.random.default_rng(SEED)
    embedding = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (buckets, DIMENSIONS)).astype(np.float32)
    output = np.zeros((DIMENSIONS, len(languages)), dtype=np.float32)
    bias = np.zeros(len(languages), dtype=np.float32)
    held = np.arange(len(rows)) % HELD_BACK == HELD_BACK - 1
    fit = np.flatnonzero(~held)

    def dense(which: np.ndarray) -> np.ndarray:
        x = np.zeros((len(which), buckets), dtype=np.float32)
        for i, k in enumerate(which):
            x[i, rows[k][0]] = rows[k][1]
        return x

    steps = max(1, EPOCHS * (-(-len(fit) // BATCH)))
    step = 0
    for _ in range(EPOCHS):
        order = random.permutation(fit)
        for a in range(0, len(order), BATCH):
            which = order[a : a + BATCH]
            x = dense(which)
            hidden = x @ embedding
            error = softmax(hidden @ output + bias)
            error[np.arange(len(which)), labels[which]] -= 1
            error /= len(which)
            rate = RATE * DIMENSIONS * (1 - step / steps)
            back = error @ output.T
            used = np.unique(np.concatenate([rows[k][0] for k in which]))
            output -= rate * (hidden.T @ error)
            bias -= rate * 0.1 * error.sum(axis=0)
            embedding[used] -= rate * (x[:, used].T @ back)
            step += 1
    scores = embedding @ output
    temperature = 1.0
    test = np.flatnonzero(held)
    if len(test):
        logits = np.stack([rows[k][1] @ scores[rows[k][0]] for k in test]) + bias
        grid = np.exp(np.linspace(np.log(0.05), np.log(5), 60))
        loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(test)), labels[test]], 1e-9)).mean() for t in grid]
        temperature = float(grid[int(np.argmin(loss))])
    return LanguageModel(languages, scores.astype(np.float32), bias, temperature)


def _histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release_memory()
    for batch in batches:
        for a, b, data, offsets in text_slices(batch["text"]):
            bucket, owner = subword_buckets(data, offsets)
            rows, shares = [], []
            order = np.argsort(owner, kind="stable")
            cuts = np.searchsorted(owner[order], np.arange(b - a + 1))
            for i in range(b - a):
                own, counts = np.unique(bucket[order[cuts[i] : cuts[i + 1]]], return_counts=True)
                rows.append(own.astype(np.uint16).tobytes())
                shares.append((counts / max(1, counts.sum())).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_pydict(
                {
                    "order": batch["order"].slice(a, b - a),
                    "lang": batch["lang"].slice(a, b - a),
                    "buckets": pa.array(rows, pa.binary()),
                    "shares": pa.array(shares, pa.binary()),
                }
            )


def language_model(documents: DataFrame, sample: int = SAMPLE) -> LanguageModel | None:
    """Train on at most `sample` documents that have a language; None if there are none.

    Every language has the same share of the sample, the first of its documents
    by a hash of the text, so that a rare one is learned too; of more than LANGUAGES,
    the most frequent are.  A doc_id that repeats is one document, and so is a text.
    """
    ship_package(documents.sparkSession)
    known = documents.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        F.xxhash64("text").alias("order"), F.col("doc_id").cast("long").alias("doc_id"), "lang", "text"
    )
    # Texts may be long: only their hashes are sorted, and the texts of the chosen are read again.
    one = known.groupBy("doc_id").agg(F.min(F.struct("order", "lang")).alias("one")).select("one.*")
    texts = stored(one.groupBy("order").agg(F.min("lang").alias("lang")), "language-texts")
    names = texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    if not names:
        return None
    first = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    chosen = (
        texts.where(F.col("lang").isin([row.lang for row in names]))
        .withColumn("_first", first)
        .where(F.col("_first") <= max(1, sample // len(names)))
        .select("order", F.col("lang").alias("of"))
    )
    rows = (
        known.select("order", "text")
        # `sample` rows of two short values.
        .join(F.broadcast(stored(chosen, "language-chosen")), "order")
        .groupBy("order")
        .agg(F.min("text").alias("text"), F.min("of").alias("lang"))
        .mapInArrow(_histograms, "order long, lang string, buckets binary, shares binary")
        .toArrow()
    )
    rows = rows.sort_by([("order", "ascending"), ("lang", "ascending")])
    texts = [
        (np.frombuffer(a, np.uint16).astype(np.int64), np.frombuffer(b, np.float32))
        for a, b in zip(rows["buckets"].to_pylist(), rows["shares"].to_pylist())
    ]
    names = rows["lang"].to_pylist()
    languages = tuple(sorted(set(names)))
    return train(texts, np.array([languages.index(name) for name in names]), languages)


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        model: LanguageModel | None = shared.value
        for batch in batches:
            letters = batch["letters"].to_numpy(zero_copy_only=False)
            for a, b, data, offsets in text_slices(batch["text"]):
                n = b - a
                names, score = np.full(n, UNKNOWN, dtype=object), np.zeros(n)
                if model is not None:
                    p = model.probabilities(data, offsets)
                    best = p.argmax(axis=1)
                    some = letters[a:b]
                    names[some] = np.array(model.languages, dtype=object)[best[some]]
                    score[some] = p[np.arange(n), best][some]
                kept = [name for name in batch.schema.names if name not in ("letters", "text")]
                yield pa.RecordBatch.from_arrays(
                    [*(batch[name].slice(a, n) for name in kept), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                    [*kept, "lang_pred", "score"],
                )

    return run


def with_language(documents: DataFrame, model: LanguageModel | None, *keep: str) -> DataFrame:
    """The columns `keep` of documents, then lang_pred and score.

    A text that is null or has no letter is `und` with score 0, and so is every
    text without a model.  An empty table gives no rows.
    """
    spark = documents.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    names = {name: f"_k{i}" for i, name in enumerate(keep)}
    rows = documents.select(*[F.col(n).alias(k) for n, k in names.items()], "text", letters.alias("letters"))
    schema = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in names.values())
    out = rows.mapInArrow(_predict(shared), f"{schema}, lang_pred string, score double")
    return out.select(*[F.col(k).alias(n) for n, k in names.items()], "lang_pred", "score")


def in_training(modulus: int = 5) -> F.Column:
    """Whether a document may be learned from: crc32 of its id as text is not 0 modulo 5."""
    return ~held_out(modulus)


def held_out(modulus: int = 5) -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == 0, F.lit(False))


def languages(documents: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Each document's language: doc_id, held_out, lang_pred, score, rejected.

    The model is learned from documents that are not held out.  rejected marks
    `und` and texts whose calibrated probability is below REJECT.  Repeated rows
    give a row each; a null doc_id is not held out; other columns are not read.
    """
    model = language_model(documents.where(in_training()), sample)
    rows = with_language(documents, model, "doc_id")
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out().alias("held_out"),
        "lang_pred",
        "score",
        ((F.col("lang_pred") == UNKNOWN) | (F.col("score") < REJECT)).alias("rejected"),
    )
