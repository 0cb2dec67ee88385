"""Ranked search of all documents for every query, best intervals of documents first.

The index holds blocks of documents.  Each block has its terms and, for each
term, a posting list: places of documents in the block, ascending, and how often
they hold the term.  A search gives every posting its impact, the term's weight
times its share for that document, and lays a sparse table for range-maximum
queries over each list.  For an interval of documents, the sum over the query's
terms of the greatest impact inside it bounds every score there.  Intervals are
taken by falling bounds and split at the document with the greatest impact, which
is scored exactly, until no bound reaches the best scores found.  Intervals of a
few documents are scored outright.  Scores are whole numbers, as in the query's contract.

A block is a row of some megabytes and a row group of its own, so that a task that
reads many has one or a few in memory at once, in Spark's reader and in Python.

Queries with equal texts are one.  They are told to the executors in blocks of
bounded size; each task keeps the best of each query through all its blocks.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, Window, functions as F

from tradescribe.llm.tables import bounded_batches, ship_package, stored

# Documents and bytes of text of a block, texts and bytes of queries told to executors at once, at most; one long text alone may have more.
BLOCK_DOCUMENTS = 4_096
BLOCK_BYTES = 16_000_000
QUERY_TEXTS = 2_000
QUERY_BYTES = 4_000_000
# Intervals split at once, and documents of an interval that is scored outright.  No result depends on these.
TOGETHER = 64
FEW = 32

BEST = 10

# Everything but digits, letters and the bytes of other characters separates terms; A to Z count as lower case.
_FOLD = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if 48 <= byte <= 57 or 97 <= byte <= 122 or byte >= 128 else 32
    for byte in range(256)
)
_SLICE = 4_000_000

INDEX = "doc_ids array<long>, lengths array<long>, terms array<binary>, starts array<int>, docs array<int>, counts array<int>"


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, in order, in lists that a long text fills one after the other."""
    data = (text or "").encode().translate(_FOLD)
    start = 0
    while start < len(data):
        end = start + _SLICE
        if end < len(data):
            end = data.find(b" ", end)
            end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


class _Numbers(dict):
    """Numbers from 0 for keys as they come."""

    def __missing__(self, key: bytes) -> int:
        number = self[key] = len(self)
        return number


class _Block:
    """Documents of one block while they are read."""

    def __init__(self) -> None:
        self.numbers = _Numbers()
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []
        self.waiting: list[np.ndarray] = []  # (document, term) of every occurrence
        self.counted: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_waiting = self.bytes = 0

    def add(self, doc_id: int | None, text: str) -> None:
        place, length = len(self.doc_ids), 0
        for terms in terms_of(text):
            found = np.fromiter(map(self.numbers.__getitem__, terms), np.int64, len(terms))
            self.waiting.append(found + (place << 32))
            self.n_waiting += len(found)
            length += len(found)
            if self.n_waiting > 500_000:
                self._count()
        if length:  # others match nothing and are not counted anywhere
            self.doc_ids.append(doc_id)
            self.lengths.append(length)
            self.bytes += len(text)

    def _count(self) -> None:
        if self.waiting:
            self.counted.append(np.unique(np.concatenate(self.waiting), return_counts=True))
        self.waiting, self.n_waiting = [], 0

    def full(self) -> bool:
        return len(self.doc_ids) >= BLOCK_DOCUMENTS or self.bytes >= BLOCK_BYTES

    def batch(self) -> pa.RecordBatch:
        self._count()
        # A document may have been counted in several parts.
        keys, where = np.unique(np.concatenate([keys for keys, _ in self.counted]), return_inverse=True)
        counts = np.bincount(where, np.concatenate([n for _, n in self.counted])).astype(np.int32)
        # Documents by id, so that of equal scores the first is the least.
        order = sorted(range(len(self.doc_ids)), key=lambda i: (self.doc_ids[i] is None, self.doc_ids[i] or 0))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        terms, docs = keys & 0xFFFFFFFF, place[keys >> 32]
        by_term = np.lexsort((docs, terms))
        starts = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=len(self.numbers)))])
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        return pa.RecordBatch.from_pydict(
            {
                "doc_ids": one([self.doc_ids[i] for i in order], pa.int64()),
                "lengths": one([self.lengths[i] for i in order], pa.int64()),
                "terms": one(list(self.numbers), pa.binary()),
                "starts": one(starts.astype(np.int32), pa.int32()),
                "docs": one(docs[by_term].astype(np.int32), pa.int32()),
                "counts": one(counts[by_term], pa.int32()),
            }
        )


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = _Block()
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
            block.add(doc_id, text.as_py() or "")
            if block.full():
                yield block.batch()
                block = _Block()
    if block.doc_ids:
        yield block.batch()


def indexed(documents: DataFrame) -> DataFrame:
    """The index of documents(doc_id, text), stored: a row for each block.

    Every row is a document of its own, also one that repeats another; a null
    text has no terms.  Documents without terms match nothing and are left out.
    Other columns are not read; an empty table has no blocks.
    """
    ship_package(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with bounded_batches(documents.sparkSession):
        return stored(rows.mapInArrow(_index, INDEX), "search-index", alone=True)


# --- queries -----------------------------------------------------------------


@dataclass
class Queries:
    """Queries told to the executors: all their terms, and for each query its terms' places and how often it has them."""

    terms: list[bytes]
    places: list[np.ndarray]
    times: list[np.ndarray]

    @classmethod
    def of(cls, texts: list[str]) -> Queries:
        numbers = _Numbers()
        places, times = [], []
        for text in texts:
            counts: Counter[bytes] = Counter()
            for terms in terms_of(text):
                counts.update(terms)
            places.append(np.array([numbers[term] for term in counts], dtype=np.int64))
            times.append(np.array(list(counts.values()), dtype=np.int64))
        return cls(list(numbers), places, times)


def _values(row: pa.RecordBatch, name: str, i: int) -> np.ndarray:
    return row[name][i].values.to_numpy(zero_copy_only=False)


def _term_places(batch: pa.RecordBatch, i: int, wanted: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The wanted terms that a block has, ascending, and their places in the block."""
    found = pc.index_in(batch["terms"][i].values, value_set=wanted)
    places = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
    terms = found.drop_null().to_numpy()
    order = np.argsort(terms)
    return terms[order].astype(np.int64), places[order]


def _statistics(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents that hold each term; term -1 counts documents and -2 all their terms."""
        wanted = pa.array(shared.value.terms, pa.binary())
        held = np.zeros(len(wanted), dtype=np.int64)
        documents = length = 0
        for batch in batches:
            for i in range(batch.num_rows):
                terms, places = _term_places(batch, i, wanted)
                starts = _values(batch, "starts", i)
                held[terms] += starts[places + 1] - starts[places]
                lengths = _values(batch, "lengths", i)
                documents += len(lengths)
                length += int(lengths.sum())
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict(
            {
                "term": pa.array(np.concatenate([some, [-1, -2]])),
                "n": pa.array(np.concatenate([held[some], [documents, length]])),
            }
        )

    return run


def term_weight(documents: int, held: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * held + 1)))


# --- search ------------------------------------------------------------------


class Postings:
    """The posting lists of some terms in one block, one after the other, with range maxima of their impacts."""

    def __init__(self, starts: np.ndarray, ends: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_docs: int):
        self.starts, self.ends, self.docs, self.impacts, self.n_docs = starts, ends, docs, impacts, n_docs
        # Ascending, as lists come by term and then by document.
        self.keys = np.repeat(np.arange(len(starts)) * n_docs, ends - starts) + docs
        # Level k has for each posting the place of the greatest impact among the 2^k from there on.
        self.levels = [np.arange(len(docs), dtype=np.int32)]
        longest = int((ends - starts).max(initial=0))
        while 2 << (len(self.levels) - 1) <= longest:
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            first, second = last[:-step], last[step:]
            level = last.copy()
            np.copyto(level[:-step], np.where(impacts[second] > impacts[first], second, first))
            self.levels.append(level)
        self.table = np.stack(self.levels) if len(docs) else np.zeros((1, 1), np.int32)
        self.log = np.zeros(longest + 2, dtype=np.int64)
        for k in range(1, len(self.levels)):
            self.log[1 << k :] = k

    def greatest(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of the greatest impact between places a and b (exclusive), and the impact; 0 where there is none."""
        some = b > a
        a, b = np.where(some, a, 0), np.where(some, b, 1)
        k = self.log[b - a]
        first, second = self.table[k, a], self.table[k, b - (1 << k)]
        best = np.where(self.impacts[second] > self.impacts[first], second, first)
        return best, np.where(some, self.impacts[best], 0)

    def find(self, terms: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each of docs (rows) and terms (columns) where the document is or would be in the list, and whether it is."""
        wanted = terms * self.n_docs + docs[:, None]
        places = np.searchsorted(self.keys, wanted)
        return places, self.keys[np.minimum(places, len(self.keys) - 1)] == wanted


class Best:
    """The best documents of one query so far, by falling score and then by id; a null id comes last."""

    def __init__(self, most: int):
        self.most = most
        self.held: list[tuple[int, bool, int]] = []
        self.floor: tuple[int, bool, int] | None = None  # the last of a full list

    def add(self, scores: np.ndarray, docs: np.ndarray, doc_ids: list[int | None]) -> None:
        if self.floor is not None:
            near = scores >= -self.floor[0]
            scores, docs = scores[near], docs[near]
        near = scores > 0
        if near.any():
            ids = [doc_ids[doc] for doc in docs[near].tolist()]
            own = [(-score, i is None, i or 0) for score, i in zip(scores[near].tolist(), ids)]
            self.held = sorted(self.held + own)[: self.most]
            if len(self.held) == self.most:
                self.floor = self.held[-1]

    def may_hold(self, bounds: np.ndarray, firsts: np.ndarray, rank_of_floor: int) -> np.ndarray:
        """Whether intervals with these bounds and first documents can better the list."""
        if self.floor is None:
            return bounds > 0
        score = -self.floor[0]
        return (bounds > score) | ((bounds == score) & (firsts < rank_of_floor))


def search_block(
    postings: Postings, terms: np.ndarray, times: np.ndarray, doc_ids: list[int | None], best: Best
) -> int:
    """Add a block's documents for one query to the best; returns how many were scored."""
    if not len(terms):
        return 0
    scored = 0

    def bounded(lo: np.ndarray, hi: np.ndarray, a: np.ndarray, b: np.ndarray) -> dict[str, np.ndarray]:
        place, impact = postings.greatest(a, b)
        return {"lo": lo, "hi": hi, "a": a, "b": b, "place": place, "impact": impact * times, "bound": (impact * times).sum(axis=1)}

    def floor_rank() -> int:
        """The first place in the block whose id is not below the last of the best."""
        if best.floor is None:
            return 0
        lo, hi = 0, len(doc_ids)
        while lo < hi:
            middle = (lo + hi) // 2
            key = (doc_ids[middle] is None, doc_ids[middle] or 0)
            lo, hi = (middle + 1, hi) if key < best.floor[1:] else (lo, middle)
        return lo

    pool = bounded(
        np.array([0]), np.array([postings.n_docs]), postings.starts[terms][None, :], postings.ends[terms][None, :]
    )
    while len(pool["bound"]):
        alive = np.flatnonzero(best.may_hold(pool["bound"], pool["lo"], floor_rank()))
        order = alive[np.argsort(-pool["bound"][alive], kind="stable")]
        now = {name: values[order[:TOGETHER]] for name, values in pool.items()}
        pool = {name: values[order[TOGETHER:]] for name, values in pool.items()}
        if not len(now["bound"]):
            break
        few = now["hi"] - now["lo"] <= FEW
        if few.any():
            a, b = now["a"][few], now["b"][few]
            lengths = (b - a).ravel()
            owner = np.repeat(np.arange(len(lengths)), lengths)
            places = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + a.ravel()[owner]
            lo = now["lo"][few]
            interval, term = owner // len(terms), owner % len(terms)
            slot = interval * FEW + postings.docs[places] - lo[interval]
            scores = np.zeros(len(lo) * FEW, dtype=np.int64)
            np.add.at(scores, slot, postings.impacts[places] * times[term])
            docs = np.repeat(lo, FEW) + np.tile(np.arange(FEW), len(lo))
            hit = np.flatnonzero(scores)
            best.add(scores[hit], docs[hit], doc_ids)
            scored += int((now["hi"] - now["lo"])[few].sum())
        wide = ~few
        if wide.any():
            now = {name: values[wide] for name, values in now.items()}
            rows = np.arange(len(now["lo"]))
            split = postings.docs[now["place"][rows, now["impact"].argmax(axis=1)]].astype(np.int64)
            places, holds = postings.find(terms, split)
            impacts = np.where(holds, postings.impacts[np.minimum(places, len(postings.impacts) - 1)], 0)
            best.add((impacts * times).sum(axis=1), split, doc_ids)
            scored += len(rows)
            halves = bounded(
                np.concatenate([now["lo"], split + 1]),
                np.concatenate([split, now["hi"]]),
                np.concatenate([now["a"], places + holds]),
                np.concatenate([places, now["b"]]),
            )
            pool = {name: np.concatenate([pool[name], halves[name]]) for name in pool}
    return scored


def _impacts(weights: np.ndarray, counts: np.ndarray, lengths: np.ndarray, documents: int, length: int) -> np.ndarray:
    """Each posting's impact; `lengths` are those of its document."""
    if 75 * int(lengths.max(initial=0)) * documents < 2**63:
        m = 25 + (75 * documents * lengths) // length
    else:
        m = np.array([25 + 75 * documents * n // length for n in lengths.tolist()], dtype=np.int64)
    return weights * ((1_000_000_000 * counts) // (1000 * counts + 8 * m))


def _search(shared, weights: np.ndarray, documents: int, length: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = shared.value
        wanted = pa.array(queries.terms, pa.binary())
        best = [Best(most) for _ in queries.places]
        for batch in batches:
            for i in range(batch.num_rows):
                terms, places = _term_places(batch, i, wanted)
                starts, lengths = _values(batch, "starts", i).astype(np.int64), _values(batch, "lengths", i)
                sizes = starts[places + 1] - starts[places]
                ends = np.cumsum(sizes)
                own = np.repeat(starts[places] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))
                docs = _values(batch, "docs", i)[own].astype(np.int64)
                counts = _values(batch, "counts", i)[own].astype(np.int64)
                impacts = _impacts(np.repeat(weights[terms], sizes), counts, lengths[docs], documents, length)
                postings = Postings(ends - sizes, ends, docs, impacts, len(lengths))
                doc_ids = batch["doc_ids"][i].as_py()
                here = np.full(len(wanted), -1)
                here[terms] = np.arange(len(terms))
                for query, (wants, times) in enumerate(zip(queries.places, queries.times)):
                    held = here[wants] >= 0
                    search_block(postings, here[wants[held]], times[held], doc_ids, best[query])
        found = [(query, own) for query, list_ in enumerate(best) for own in list_.held]
        yield pa.RecordBatch.from_pydict(
            {
                "query": pa.array([query for query, _ in found], pa.int32()),
                "doc_id": pa.array([None if own[1] else own[2] for _, own in found], pa.int64()),
                "score": pa.array([-own[0] for _, own in found], pa.int64()),
                "task": pa.array([TaskContext.get().partitionId()] * len(found), pa.int32()),
            }
        )

    return run


def _ranked(found: DataFrame, most: int, *group: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _one_block(index: DataFrame, texts: list[Row], most: int) -> DataFrame:
    """digest, rank, doc_id, score for a block of texts(digest, text)."""
    spark = index.sparkSession
    shared = spark.sparkContext.broadcast(Queries.of([row.text for row in texts]))
    counted = index.select("lengths", "terms", "starts").mapInArrow(_statistics(shared), "term long, n long")
    known = dict(counted.groupBy("term").agg(F.sum("n")).collect())
    documents, length = known.get(-1, 0), known.get(-2, 0)
    weights = np.array([term_weight(documents, known.get(i, 0)) for i in range(len(shared.value.terms))], dtype=np.int64)
    found = index.mapInArrow(
        _search(shared, weights, documents, length, most), "query int, doc_id long, score long, task int"
    )
    # Many tasks' lists shrink in two steps.
    some = _ranked(found.withColumn("_some", F.col("task") % 64), most, "query", "_some").drop("rank")
    digests = spark.createDataFrame([(i, row.digest) for i, row in enumerate(texts)], "query int, digest string")
    ranked = _ranked(some, most, "query").join(F.broadcast(digests), "query")
    out = stored(ranked.select("digest", "rank", "doc_id", "score"), "search-found")
    shared.unpersist()
    return out


def query_blocks(texts: DataFrame) -> Iterator[list[Row]]:
    """texts(digest, text) in lists of bounded count and size; a longer text comes alone."""
    sized = stored(texts, "search-texts").withColumn("bytes", F.octet_length("text"))
    blocks = 1
    while True:
        block = F.pmod(F.xxhash64("digest"), F.lit(blocks))
        sizes = sized.groupBy(block.alias("block")).agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
        over = (F.col("n") > 1) & ((F.col("n") > QUERY_TEXTS) | (F.col("bytes") > QUERY_BYTES))
        if sizes.where(over).isEmpty():
            break
        blocks *= 2
    for number in range(blocks):
        rows = sized.where(block == number).select("digest", "text").orderBy("digest").collect()
        if rows:
            yield rows


def search(index: DataFrame, items: DataFrame, most: int = BEST) -> DataFrame:
    """The `most` documents of the index with the highest scores above 0 for each of items(item_id, text): item_id, rank, doc_id, score.

    Equal scores come by ascending doc_id, nulls last; documents with the same id
    are ranked one by one.  An item without terms, as with a null text, or whose
    terms no document has, gives no rows.  Items that repeat give rows each.
    Other columns are not read; no items or an empty index give no rows.
    """
    spark = index.sparkSession
    ship_package(spark)
    asked = items.select(
        F.col("item_id").cast("long").alias("item_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("digest"),
    )
    found = spark.createDataFrame([], "digest string, rank int, doc_id long, score long")
    with bounded_batches(spark):
        for block in query_blocks(asked.groupBy("digest").agg(F.first("text").alias("text"))):
            found = found.unionAll(_one_block(index, block, most))
    return asked.select("item_id", "digest").join(found, "digest").select("item_id", "rank", "doc_id", "score")


def ranked_search(documents: DataFrame, items: DataFrame, most: int = BEST) -> DataFrame:
    """The same from documents(doc_id, text), over all of them."""
    return search(indexed(documents), items, most)
