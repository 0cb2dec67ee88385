"""Toxicity from the nearest labelled examples under TF-IDF cosine.

Terms are words.  All words of the labelled sample span the vectors, weighted by
their rarity in all documents and by relevance frequency (Lan et al., 2009),
which raises those that toxic examples hold more often and drops none; a word
that no example holds is in no vector.  Examples with equal vectors are one, with
counts of both labels.

The vectors lie in blocks of similar ones.  The index has for each term its
postings, and for each block that holds the term the greatest weight there.  The
most frequent terms, which most texts and vectors share, are columns of a matrix
instead, multiplied with many texts at once, in single precision.  The greatest such
product in a block and a text's other weights times their maxima there, summed, bound
every cosine in the block.  Blocks are taken by falling bounds and completed from the
postings, until no bound reaches the cosine of the last neighbour.  All these
comparisons allow for the error of single precision, and the vectors that pass them
are compared again in double precision, so the nearest are exact.
Neighbours vote by their distance, and the votes are calibrated on the sample
itself, each example left out of its own vote and of its terms' relevance.

A text without any term of the sample has no neighbours and the share of toxic
examples among those like it.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradescribe.llm.ranked_search import terms_of
from tradescribe.llm.tables import release_memory, ship_package, shuffle_partitions, stored

# Labelled documents the examples and terms are learned from, and bytes of their texts, at most; the first by a hash.
SAMPLE = 12_000
SAMPLE_BYTES = 48_000_000

NEIGHBOURS = 25
# Vectors of a block, blocks completed before the bounds are looked at, and columns of the matrix of frequent terms, at
# most; no result depends on them.
BLOCK = 1_024
FIRST = 2
FREQUENT = 300
# More than two errors of a cosine whose frequent terms are summed in single precision: FREQUENT + 2 roundings of at
# most 2**-24 of the product of two lengths of at most 1.
SLACK = 1e-4
SMALLEST = np.finfo(float).smallest_subnormal
# Texts that are multiplied at once.
TOGETHER = 64
# The most frequent terms, which tell what vectors are similar.
AXES = 256
# Distinct words whose texts are counted at once, unless one text has more.
WORDS = 50_000
PRIOR = 1.0  # weight of the base rate in a vote
THRESHOLD = 0.3

Text = tuple[np.ndarray, np.ndarray]  # terms, ascending, and their counts or weights


class Vocabulary:
    """Numbers of terms, in their order."""

    def __init__(self, terms: pa.Array):
        self.terms = terms

    def __getstate__(self) -> pa.Array:
        return self.terms

    def __setstate__(self, terms: pa.Array) -> None:
        self.terms = terms

    @cached_property
    def number(self) -> dict[bytes, int]:
        return {term: i for i, term in enumerate(self.terms.to_pylist())}

    def frequent_first(self, idf: np.ndarray) -> None:
        """Lay the numbers of frequent terms, by their rarity, side by side in memory, where looking up words finds them faster."""
        if "number" not in self.__dict__:
            order = np.argsort(idf, kind="stable")
            self.number = dict(zip(self.terms.take(pa.array(order)).to_pylist(), order.tolist()))

    def counted(self, text: str | None) -> Text:
        """The terms of the vocabulary in a text, ascending, and how often it has them."""
        words: Counter[bytes] = Counter()
        for some in terms_of(text):
            words.update(some)
        return self.numbered(words)

    def numbered(self, words: Counter[bytes]) -> Text:
        """Those of the words that are terms of the vocabulary, ascending, and their counts."""
        numbers = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        counts = np.fromiter(words.values(), np.int64, len(words))
        order = np.argsort(numbers)
        order = order[np.searchsorted(numbers[order], 0) :]
        return numbers[order], counts[order]


def _slices(batches: Iterator[pa.RecordBatch], most: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, most):
            yield batch.slice(start, most)


def _distinct_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The terms of a partition's examples, once for some examples each."""
    for rows in _slices(batches):
        found: set[bytes] = set()
        for text in rows["text"].to_pylist():
            for words in terms_of(text):
                found.update(words)
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.binary())], ["term"])


def _example_vectors(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each example's terms by number, ascending, and their counts, packed."""
        vocabulary: Vocabulary = shared.value
        for rows in _slices(batches, TOGETHER):
            vectors = [vocabulary.counted(text) for text in rows["text"].to_pylist()]
            sizes = pa.array([len(terms) for terms, _ in vectors], pa.int32())
            terms = [packed(np.diff(terms, prepend=0).astype("<i4")) for terms, _ in vectors]
            counts = [packed(counts.astype("<i4")) for _, counts in vectors]
            yield pa.RecordBatch.from_arrays(
                [rows["doc_id"], rows["toxic"], sizes, pa.array(terms, pa.binary()), pa.array(counts, pa.binary())],
                ["doc_id", "toxic", "size", "terms", "counts"],
            )

    return run


def _document_counts(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many documents of a partition hold each term; term -1 counts the documents."""
        vocabulary: Vocabulary = shared.value
        total = np.zeros(len(vocabulary.terms), dtype=np.int64)
        documents = 0
        holders: Counter[bytes] = Counter()

        def count() -> None:
            terms, texts = vocabulary.numbered(holders)
            total[terms] += texts
            holders.clear()

        for rows in _slices(batches):
            for text in rows["text"].to_pylist():
                words: set[bytes] = set()
                for some in terms_of(text):
                    words.update(some)
                holders.update(words)
                # A word that many texts share is looked up once for all of them.
                if len(holders) > WORDS:
                    count()
            documents += rows.num_rows
        count()
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict(
            {"term": pa.array(np.append(held, -1)), "n": pa.array(np.append(total[held], documents))}
        )

    return run


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    numbers = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    numbers += np.arange(len(numbers))
    return numbers


class Postings:
    """For each term the vectors that hold it and its weights there, in runs of one block with their greatest weight."""

    def __init__(self, terms: np.ndarray, vectors: np.ndarray, weights: np.ndarray, n_terms: int, n_vectors: int):
        order = np.argsort(terms, kind="stable")  # the vectors already ascend
        terms = terms[order]
        # A posting's vector and weight lie side by side, and are read as one number.
        self.pairs = np.empty(len(terms), [("where", "<i4"), ("value", "<f4")])
        self.pairs["where"], self.pairs["value"] = vectors[order], weights[order]
        del order, vectors, weights
        held = np.bincount(terms, minlength=n_terms)
        self.starts = np.concatenate([[0], np.cumsum(held)])
        self.n_blocks = -(-n_vectors // BLOCK)
        often = np.argsort(-held, kind="stable")[:FREQUENT]
        often = often[held[often] * 16 > n_vectors]
        self.column = np.full(n_terms, -1)
        self.column[often] = np.arange(len(often))
        self.matrix = np.zeros((self.n_blocks * BLOCK, len(often)), np.float32)
        for i, term in enumerate(often.tolist()):
            own = slice(self.starts[term], self.starts[term + 1])
            self.matrix[self.where[own], i] = self.values[own]
        block = self.where // BLOCK
        first = np.ones(len(terms), dtype=bool)
        first[1:] = (terms[1:] != terms[:-1]) | (block[1:] != block[:-1])
        self.run_start = np.flatnonzero(first).astype(np.int32)
        self.run_size = np.diff(np.append(self.run_start, np.int32(len(terms))))
        self.run_block = block[self.run_start]
        self.run_max = np.maximum.reduceat(self.values, self.run_start) if len(terms) else self.values
        self.runs = np.concatenate([[0], np.cumsum(np.bincount(terms[self.run_start], minlength=n_terms))])

    @property
    def where(self) -> np.ndarray:
        return self.pairs["where"]

    @property
    def values(self) -> np.ndarray:
        return self.pairs["value"]

    def items(self) -> Iterator[tuple[int, Text]]:
        for term in np.flatnonzero(np.diff(self.starts)).tolist():
            a, b = self.starts[term], self.starts[term + 1]
            yield term, (self.where[a:b], self.values[a:b])

    def largest(self, texts: list[Text], k: int, without: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """For each text, a vector of length 1, the vectors with the k largest cosines above 0 and all that tie with the last, their cosines, and how many blocks were completed."""
        often = np.zeros((len(texts), self.matrix.shape[1]))
        for i, (terms, own) in enumerate(texts):
            column = self.column[terms]
            often[i, column[column >= 0]] = own[column >= 0]
        products = often.astype(np.float32) @ self.matrix.T
        out = []
        for i, (terms, own) in enumerate(texts):
            rare = self.column[terms] < 0
            ids, rest, done = self._completed(terms[rare], own[rare], products[i], k, without[i] if without else -1)
            cosines = rest + self.matrix[ids].astype(np.float64) @ often[i]
            near = (cosines > 0) & (cosines >= kth_largest(cosines, k) - 1e-9)
            out.append((ids[near], cosines[near], done))
        return out

    def _completed(
        self, terms: np.ndarray, weights: np.ndarray, products: np.ndarray, k: int, without: int
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """Vectors among which the k nearest are, what the terms outside the matrix give to their cosines, and how many blocks were completed."""
        sizes = self.runs[terms + 1] - self.runs[terms]
        runs = _ranges(self.runs[terms], sizes)
        weight = np.repeat(weights, sizes)
        block = self.run_block[runs]
        by_block = products.reshape(self.n_blocks, BLOCK)
        bounds = np.bincount(block, self.run_max[runs] * weight, self.n_blocks) + by_block.max(axis=1)
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        now, left = order[:FIRST], order[FIRST:]
        completed: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # blocks, without and with the frequent terms
        best = np.zeros(0)
        least = SMALLEST
        for _ in range(2):
            here = np.zeros(self.n_blocks, dtype=bool)
            here[now] = True
            hit = here[block]
            own = runs[hit]
            times = self.run_size[own]
            pairs = self.pairs.view("<i8").take(_ranges(self.run_start[own], times)).view(self.pairs.dtype)
            new = np.bincount(pairs["where"], pairs["value"] * np.repeat(weight[hit], times), len(products))
            if without >= 0:
                new[without] = -np.inf
            new = new.reshape(by_block.shape)[now].ravel()
            cosines = new + by_block[now].ravel()
            completed.append((now, new, cosines))
            best = np.concatenate([best, cosines[cosines >= least]])
            least = max(kth_largest(best, k) - SLACK, SMALLEST)
            now = left[bounds[left] >= least]
        ids, rest = [], []
        for now, new, cosines in completed:
            some = np.flatnonzero(cosines >= least)
            ids.append(now[some // BLOCK] * BLOCK + some % BLOCK)
            rest.append(new[some])
        return np.concatenate(ids), np.concatenate(rest), sum(len(now) for now, _, _ in completed)


def kth_largest(values: np.ndarray, k: int) -> float:
    """The k-th largest of positive values, 0 if there are fewer."""
    return float(np.partition(values, -k)[-k]) if len(values) >= k else 0.0


def packed(values: np.ndarray) -> bytes:
    """Whole numbers of four bytes, compressed byte by byte, as their upper bytes are mostly zero."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").ravel()


@dataclass
class Index:
    """Distinct example vectors in blocks of similar ones, and for each term its postings."""

    idf: np.ndarray  # rarity of each term
    bad: np.ndarray  # toxic examples that hold it
    good: np.ndarray  # others
    toxic: np.ndarray  # toxic examples of each vector
    total: np.ndarray  # all examples of each vector
    ids: np.ndarray  # smallest doc_id of each vector
    cuts: np.ndarray  # where each vector's terms begin, and their end
    terms: np.ndarray  # of all vectors, ascending within each
    counts: np.ndarray
    base_rate: float  # of all examples
    empty_rate: float  # of the examples without a term
    calibration: tuple[np.ndarray, np.ndarray] = (np.zeros(0), np.zeros(0))

    def __getstate__(self) -> dict:
        """Packed, as it goes to every executor; what follows from the vectors stays behind."""
        state = {name: getattr(self, name) for name in self.__dataclass_fields__}
        steps = np.diff(self.terms, prepend=np.int32(0)).astype("<i4")
        steps[self.cuts[:-1]] = self.terms[self.cuts[:-1]]
        return state | {"terms": packed(steps), "counts": packed(self.counts.astype("<i4"))}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        steps = unpacked(state["terms"], int(self.cuts[-1]))
        sums = np.cumsum(steps, dtype=np.int64)
        before = (sums - steps)[self.cuts[:-1]]
        self.terms = (sums - np.repeat(before, np.diff(self.cuts))).astype(np.int32)
        self.counts = unpacked(state["counts"], int(self.cuts[-1]))

    def vector(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Terms and counts."""
        a, b = self.cuts[i], self.cuts[i + 1]
        return self.terms[a:b], self.counts[a:b]

    @cached_property
    def term_weights(self) -> np.ndarray:
        return self.idf * relevance(self.bad, self.good)

    def all_weights(self) -> np.ndarray:
        """Of all vectors, each of length 1."""
        w = (1 + np.log(self.counts)) * self.term_weights[self.terms]
        owner = np.repeat(np.arange(len(self.total)), np.diff(self.cuts))
        return w / np.sqrt(np.bincount(owner, w * w, len(self.total)))[owner]

    @cached_property
    def postings(self) -> Postings:
        owner = np.repeat(np.arange(len(self.total), dtype=np.int32), np.diff(self.cuts))
        return Postings(self.terms, owner, self.all_weights(), len(self.idf), len(self.total))

    def searched_only(self) -> None:
        """Give up what only the examples' own votes need."""
        if len(self.total) and len(self.terms):
            _ = self.postings
            self.terms = self.counts = np.zeros(0, np.int32)

    def weights(self, terms: np.ndarray, counts: np.ndarray, without: int | None = None) -> np.ndarray:
        """Of a text; as an example with the label `without`, it is left out of its terms' relevance."""
        if without is None:
            w = (1 + np.log(counts)) * self.term_weights[terms]
        else:
            bad, good = np.maximum(0, self.bad[terms] - without), np.maximum(0, self.good[terms] - (1 - without))
            w = (1 + np.log(counts)) * self.idf[terms] * relevance(bad, good)
        return w / np.sqrt((w * w).sum())

    def nearest_of(self, texts: list[Text], k: int, without: list[int] | None = None) -> list[Text]:
        """For each text the vectors with the k largest cosines above 0, and these; all that tie with the last; `without` names one each to leave out."""
        out = []
        for a in range(0, len(texts), TOGETHER):
            for ids, cosines, _ in self.postings.largest(texts[a : a + TOGETHER], k, without and without[a : a + TOGETHER]):
                order = np.lexsort((self.ids[ids], -cosines))
                out.append((ids[order], np.minimum(cosines[order], 1.0)))
        return out

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> Text:
        """The same for one text."""
        return self.nearest_of([(terms, weights)], k)[0]

    def vote(self, ids: np.ndarray, cosines: np.ndarray, own: tuple[int, int, int] | None = None) -> float:
        """The neighbours' votes, nearer ones count more; own (vector, toxic, total) is taken out of its vector."""
        weight = 1 / (1.05 - cosines)
        toxic, total = self.toxic[ids].astype(float), self.total[ids].astype(float)
        if own is not None:
            toxic[ids == own[0]] -= own[1]
            total[ids == own[0]] -= own[2]
        # A vector speaks with the logarithm of its examples, so that copies do not drown the others.
        share = np.divide(toxic, total, out=np.zeros_like(toxic), where=total > 0)
        weight = weight * np.log1p(total)
        return float(((weight * share).sum() + PRIOR * self.base_rate) / (weight.sum() + PRIOR))

    def calibrated(self, vote: float) -> float:
        votes, rates = self.calibration
        return float(np.interp(vote, votes, rates)) if len(votes) else vote

    def scores(self, texts: list[Text]) -> list[tuple[float, list[int]]]:
        """The calibrated score of each text, given by its terms and counts, and the doc_ids of its nearest examples."""
        out: list[tuple[float, list[int]]] = [(self.empty_rate, [])] * len(texts)
        if not len(self.total):
            return out
        some = [i for i, (terms, _) in enumerate(texts) if len(terms)]
        found = self.nearest_of([(texts[i][0], self.weights(*texts[i])) for i in some], NEIGHBOURS)
        for i, (ids, near) in zip(some, found):
            if len(ids):
                out[i] = self.calibrated(self.vote(ids, near)), self.ids[ids[:3]].tolist()
        return out


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing step function of x nearest to y, as points at the means of its steps."""
    steps: list[list[float]] = []  # x mean, y mean, weight
    for i in np.argsort(x, kind="stable"):
        steps.append([float(x[i]), float(y[i]), float(weight[i])])
        while len(steps) > 1 and steps[-2][1] >= steps[-1][1]:
            x1, y1, w1 = steps.pop()
            x0, y0, w0 = steps.pop()
            w = w0 + w1
            steps.append([(x0 * w0 + x1 * w1) / w, (y0 * w0 + y1 * w1) / w, w])
    table = np.array(steps).reshape(-1, 3)
    # Each step is shrunk towards one half by one example of each label.
    return table[:, 0], (table[:, 1] * table[:, 2] + 0.5) / (table[:, 2] + 1)


def digest(terms: np.ndarray, counts: np.ndarray) -> bytes:
    return hashlib.blake2b(terms.tobytes() + counts.tobytes(), digest_size=16).digest()


def relevance(toxic: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Relevance frequency of terms in so many toxic and other examples, 1 at least."""
    return np.log2(2 + toxic / np.maximum(1, other))


def own_votes(index: Index, first: int = 0, last: int | None = None) -> np.ndarray:
    """The votes on vectors from `first` to `last`: with a toxic and with another example left out."""
    last = len(index.total) if last is None else last
    out = np.zeros((last - first, 2))
    some = [
        (i, place, label)
        for i in range(first, last)
        for place, label in enumerate((1, 0))
        if (index.toxic[i] if label else index.total[i] > index.toxic[i])
    ]
    texts = [(index.vector(i)[0], index.weights(*index.vector(i), label)) for i, _, label in some]
    for (i, place, label), near in zip(some, index.nearest_of(texts, NEIGHBOURS)):
        out[i - first, place] = index.vote(*near, (i, label, 1))
    return out


def dealt_votes(spark: SparkSession) -> Callable[[Index], np.ndarray]:
    """The same for all vectors, computed by the executors."""

    def votes(index: Index) -> np.ndarray:
        shared = spark.sparkContext.broadcast(index)
        n = len(index.total)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in batch["id"].to_pylist():
                    own = own_votes(shared.value, a, min(a + TOGETHER, n))
                    yield pa.RecordBatch.from_pydict(
                        {"vector": pa.array(np.arange(a, a + len(own))), "toxic": pa.array(own[:, 0]), "other": pa.array(own[:, 1])}
                    )

        groups = spark.range(0, n, TOGETHER, shuffle_partitions(spark))
        found = groups.mapInArrow(run, "vector long, toxic double, other double").toArrow().sort_by("vector")
        shared.unpersist()
        return np.stack([found["toxic"].to_numpy(), found["other"].to_numpy()], axis=1)

    return votes


def similar_order(cuts: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_terms: int) -> np.ndarray:
    """An order in which neighbouring vectors are similar: halves along the main directions of the most frequent terms."""
    n = len(cuts) - 1
    held = np.bincount(terms, minlength=n_terms)
    axes = np.argsort(-held, kind="stable")[:AXES]
    row = np.full(n_terms, -1)
    row[axes] = np.arange(len(axes))
    owner = np.repeat(np.arange(n), np.diff(cuts))
    kept = row[terms] >= 0
    matrix = np.zeros((n, len(axes)))
    matrix[owner[kept], row[terms[kept]]] = weights[kept]
    _, directions = np.linalg.eigh(matrix.T @ matrix)
    along = matrix @ directions[:, ::-1][:, :6]

    def halves(members: np.ndarray, depth: int) -> list[np.ndarray]:
        if len(members) <= BLOCK:
            return [members]
        members = members[np.argsort(along[members, depth % along.shape[1]], kind="stable")]
        middle = -(-len(members) // (2 * BLOCK)) * BLOCK
        return halves(members[:middle], depth + 1) + halves(members[middle:], depth + 1)

    return np.concatenate(halves(np.arange(n), 0))


def build_index(
    examples: list[tuple[int, int, np.ndarray, np.ndarray]],
    idf: np.ndarray,
    votes: Callable[[Index], np.ndarray] = own_votes,
    relevant: bool = False,
) -> Index:
    """examples: (doc_id, label, terms, counts), terms ascending; votes: own_votes or the like; relevant: weigh terms by their labels."""
    bad, good = np.zeros(len(idf), dtype=np.int32), np.zeros(len(idf), dtype=np.int32)
    groups: dict[bytes, list] = {}  # by digest
    empty = [0, 0]
    for doc_id, toxic, terms, counts in examples:
        if not len(terms):
            empty[0] += toxic
            empty[1] += 1
            continue
        if relevant:
            (bad if toxic else good)[terms] += 1
        group = groups.setdefault(digest(terms, counts), [terms, counts, 0, 0, doc_id])
        group[2] += toxic
        group[3] += 1
        group[4] = min(group[4], doc_id)
    distinct = sorted(groups.values(), key=lambda g: g[4])
    everything = max(1, sum(g[3] for g in distinct) + empty[1])
    base = (sum(g[2] for g in distinct) + empty[0]) / everything

    def index_of(distinct: list) -> Index:
        return Index(
            idf,
            bad,
            good,
            np.array([g[2] for g in distinct], dtype=np.int64),
            np.array([g[3] for g in distinct], dtype=np.int64),
            np.array([g[4] for g in distinct], dtype=np.int64),
            np.cumsum([0, *(len(g[0]) for g in distinct)]),
            np.concatenate([np.zeros(0, np.int32), *(g[0] for g in distinct)]).astype(np.int32),
            np.concatenate([np.zeros(0, np.int32), *(g[1] for g in distinct)]).astype(np.int32),
            base,
            (empty[0] + base) / (empty[1] + 1),
        )

    index = index_of(distinct)
    if not distinct:
        return index
    order = similar_order(index.cuts, index.terms, index.all_weights(), len(idf))
    index = index_of([distinct[i] for i in order.tolist()])
    own = votes(index)
    label = np.tile([1.0, 0.0], len(distinct))
    size = np.stack([index.toxic, index.total - index.toxic], axis=1).ravel().astype(float)
    index.calibration = isotonic(own.ravel()[size > 0], label[size > 0], size[size > 0])
    return index


def may_learn(modulus: int = 4, held: int = 2) -> Column:
    """Whether a document's label may be learned from: crc32 of its id as text is not 2 modulo 4."""
    return ~is_held_out(modulus, held)


def is_held_out(modulus: int = 4, held: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == held, F.lit(False))


def fit(
    documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES
) -> tuple[Vocabulary, Index]:
    """Learn examples and the weights of their terms from documents whose labels may be learned from.

    At most `sample` labelled documents of `sample_bytes` together are used, the
    first by a hash of doc_id.  Of a doc_id that repeats, the smallest text is
    the example.  How rare a term is counts over all documents.
    """
    spark = documents.sparkSession
    ship_package(spark)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & may_learn())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"))
        .limit(sample)
    )
    # `sample` rows of two numbers, and one example of each.
    chosen = texts.join(F.broadcast(spark.createDataFrame(known.toArrow())), "doc_id")
    examples = stored(
        chosen.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")), "toxicity-examples"
    )
    sizes = examples.select("doc_id", F.octet_length("text").alias("n")).orderBy(F.xxhash64("doc_id")).toArrow()
    fits = np.cumsum(sizes["n"].to_numpy()) <= sample_bytes
    few = spark.createDataFrame(pa.table({"doc_id": sizes["doc_id"].combine_chunks().filter(pa.array(fits))}))
    examples = stored(examples.join(F.broadcast(few), "doc_id"), "toxicity-sample")
    # The words of at most `sample_bytes` of text.
    terms = examples.mapInArrow(_distinct_terms, "term binary").distinct().orderBy("term").toArrow()["term"]
    vocabulary = Vocabulary(terms.combine_chunks())
    shared = spark.sparkContext.broadcast(vocabulary)
    counts = texts.mapInArrow(_document_counts(shared), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    frequency = np.zeros(len(vocabulary.terms), dtype=np.int64)
    known_counts = counts.toArrow()
    term, n = known_counts["term"].to_numpy(), known_counts["n"].to_numpy()
    total = int(n[term < 0].sum())
    frequency[term[term >= 0]] = n[term >= 0]
    found = examples.mapInArrow(
        _example_vectors(shared), "doc_id long, toxic int, size int, terms binary, counts binary"
    ).toArrow()
    shared.unpersist()
    rows = []
    for doc_id, label, size, own, times in zip(*(found[name].to_pylist() for name in found.column_names)):
        rows.append((doc_id, label, np.cumsum(unpacked(own, size), dtype=np.int32), unpacked(times, size)))
    del found
    idf = np.log((total + 1) / (frequency + 1)) + 1
    return vocabulary, build_index(rows, idf, dealt_votes(spark), relevant=True)


def _scored(shared, text: str, *keep: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, index = shared.value
        index.searched_only()
        vocabulary.frequent_first(index.idf)
        release_memory()
        known: dict[bytes, tuple[float, list[int]]] = {}
        for rows in _slices(batches):
            own = [vocabulary.counted(own) for own in rows[text].to_pylist()]
            keys = [digest(*counted) for counted in own]
            if len(known) > 10_000:
                known.clear()
            new = {key: counted for key, counted in zip(keys, own) if key not in known}
            known.update(zip(new, index.scores(list(new.values()))))
            scores = [known[key][0] for key in keys]
            evidence = [known[key][1] for key in keys]
            yield pa.RecordBatch.from_arrays(
                [*(rows[name] for name in keep), pa.array(scores, pa.float64()), pa.array(evidence, pa.list_(pa.int64()))],
                [*keep, "score", "evidence"],
            )

    return run


def with_toxicity(documents: DataFrame, vocabulary: Vocabulary, index: Index, *keep: str) -> DataFrame:
    """The columns `keep` of documents, then score and evidence, the ids of the nearest examples."""
    spark = documents.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast((vocabulary, index))
    names = {name: f"_k{i}" for i, name in enumerate(keep)}
    # A text that is kept travels once.
    text = names.get("text", "text")
    rows = documents.select(*[F.col(n).alias(k) for n, k in names.items()], *([] if "text" in names else ["text"]))
    schema = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in names.values())
    out = rows.mapInArrow(_scored(shared, text, *names.values()), f"{schema}, score double, evidence array<long>")
    return out.select(*[F.col(k).alias(n) for n, k in names.items()], "score", "evidence")


def toxicity(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Each document's score: doc_id, held_out, score, predicted, evidence.

    Labels are learned only from documents that are not held out.  A null or
    empty text scores as the examples without a term do, 0 without any labels.
    Repeated rows give a row each; a label that repeats counts once, as toxic if
    one is; null labels and other columns are not used; an empty table gives no rows.
    """
    vocabulary, index = fit(documents, labels, sample)
    rows = with_toxicity(documents, vocabulary, index, "doc_id")
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        is_held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "evidence",
    )
