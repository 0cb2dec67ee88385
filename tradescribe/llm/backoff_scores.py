"""Stupid-backoff scores of documents under the counts of the whole corpus (Brants et al., 2007).

The counts never meet in one place.  A chunk of documents is exploded into its
n-grams, which shrink to distinct ones with their counts and are dealt out by
hash.  The task that owns a hash range adds up its part of the count tables and
joins it back to the n-grams of each chunk, so a chunk receives the corpus
counts of exactly the n-grams it holds.  There the scores of its documents are
summed.  A frequent word is one n-gram of a chunk, however often it occurs.

Chunks are runs of rows of an input partition.  They are formed twice, once for
the n-grams and once for the scores; that the counts fit the chunk is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tradescribe.llm.tables import ship_package, shuffle_partitions
from tradescribe.llm.words import gram_hashes, text_slices, word_hashes, words_of

BACKOFF = 0.4
LEAST_COUNT = 2
ORDER = 2

# Bytes of text in a chunk, at least, unless the partition ends.
CHUNK_BYTES = 12_000_000


def packed_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit values as compressed differences, whose upper bytes are mostly zero."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked_sorted(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    if not n:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(pa.decompress(data[8:], 8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


def chunks(batches: Iterator[pa.RecordBatch], most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows of a partition that depend on its rows alone, not on how they come in batches."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy()
        begun = 0
        while begun < batch.num_rows:
            ends = size + np.cumsum(lengths[begun:])
            full = int(np.searchsorted(ends, most))
            if full == len(ends):
                held.append(batch.slice(begun))
                size = int(ends[-1])
                break
            held.append(batch.slice(begun, full + 1))
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size, begun = [], 0, begun + full + 1
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = sum(len(words_of(data, offsets)[0]) for _, _, data, offsets in text_slices(batch["text"]))
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All words of a chunk as hashes, and the place of each text's first one."""
    hashes, firsts, n = [], [np.zeros(1, np.int64)], 0
    for _, _, data, offsets in text_slices(texts):
        starts, ends, first = words_of(data, offsets)
        hashes.append(word_hashes(data, starts, ends))
        firsts.append(first[1:] + n)
        n += len(starts)
    return np.concatenate(hashes or [np.zeros(0, np.uint64)]), np.concatenate(firsts)


def chunk_grams(hashes: np.ndarray, firsts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of a chunk, and where each ends; none spans two texts."""
    grams = gram_hashes(hashes, n) if n > 1 else hashes
    inside = np.ones(len(hashes), dtype=bool)
    for k in range(n - 1):
        starts = firsts[:-1] + k
        inside[starts[starts < firsts[1:]]] = False
    ends = np.flatnonzero(inside)
    ends = ends[ends >= n - 1]
    return grams[ends - n + 1], ends


_GRAMS = "bucket int, chunk long, place int, n int, grams binary, counts binary"


def _explode(order: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for k, chunk in enumerate(chunks(batches)):
            hashes, firsts = hashed_words(chunk["text"])
            for n in range(1, order + 1):
                grams, counts = np.unique(chunk_grams(hashes, firsts, n)[0], return_counts=True)
                counts = counts.astype(np.uint32)
                # Sorted hashes fall into sorted ranges, one for each bucket.
                share = (1 << 64) // buckets + 1
                cuts = np.searchsorted(grams, np.array([b * share for b in range(1, buckets)], dtype=np.uint64))
                cuts = [0, *cuts.tolist(), len(grams)]
                rows = [(b, cuts[b], cuts[b + 1]) for b in range(buckets) if cuts[b] < cuts[b + 1]]
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array([b for b, _, _ in rows], pa.int32()),
                        "chunk": pa.array([task << 32 | k] * len(rows), pa.int64()),
                        "place": pa.array([b for b, _, _ in rows], pa.int32()),
                        "n": pa.array([n] * len(rows), pa.int32()),
                        "grams": pa.array([packed_sorted(grams[a:b]) for _, a, b in rows], pa.binary()),
                        "counts": pa.array([counts[a:b].tobytes() for _, a, b in rows], pa.binary()),
                    }
                )

    return run


_COUNTS = "chunk long, place int, n int, check_sum long, counts binary, total long"


def check_sum(grams: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(grams * np.uint64(3) + np.uint64(1), initial=np.uint64(0)).view(np.int64))


def _count(table: pa.Table) -> pa.Table:
    """Corpus counts of a hash range for one n, for each chunk in the order of its n-grams."""
    grams = [unpacked_sorted(x.as_py()) for x in table["grams"]]
    counts = [np.frombuffer(x, np.uint32) for x in table["counts"].to_pylist()]
    distinct, place = np.unique(np.concatenate(grams), return_inverse=True)
    totals = np.bincount(place, np.concatenate(counts), len(distinct)).astype(np.uint64)
    ends = np.cumsum([len(x) for x in grams])
    parts = [totals[place[end - len(x) : end]] for x, end in zip(grams, ends)]
    # Most counts are small: four bytes hold nearly all of them, eight the others.
    parts = [x.astype(np.uint32) if not len(x) or x.max() < 1 << 32 else x for x in parts]
    return pa.table(
        {
            "chunk": table["chunk"],
            "place": table["place"],
            "n": table["n"],
            "check_sum": pa.array([check_sum(x) for x in grams], pa.int64()),
            "counts": pa.array([x.tobytes() for x in parts], pa.binary()),
            "total": pa.array([int(x.sum(dtype=np.uint64)) for x in counts], pa.int64()),
        }
    )


def backoff_logs(
    counts: list[np.ndarray], ends: list[np.ndarray], words: int, total: int, least: int, backoff: float
) -> tuple[np.ndarray, np.ndarray]:
    """Log score of each word, and by how many words its context was cut short.

    counts[n] and ends[n] belong to the n-grams of n + 1 words: how often each
    occurs in the corpus, and the word at which it ends.
    """
    longest = np.zeros(words, dtype=np.int64)  # the longest context there is in the text
    used = np.zeros(words, dtype=np.int64)  # the longest whose n-gram is frequent enough
    logs = np.log(counts[0] / total) if words else np.zeros(0)
    context = counts[0].astype(np.float64)
    at = np.zeros(words)
    for n in range(1, len(counts)):
        here = ends[n]
        longest[here] = n
        seen = counts[n] >= least
        logs[here[seen]] = np.log(counts[n][seen] / context[here[seen] - 1])
        used[here[seen]] = n
        at[:] = 0
        at[here] = counts[n]
        context = at.copy()
    return logs + (longest - used) * np.log(backoff), longest - used


_SCORES = "doc_id long, n_words long, n_backoff long, log_score double"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    for k, chunk in enumerate(chunks(batches)):
        texts = pa.table({"doc_id": chunk["doc_id"], "text": chunk["text"]})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, texts.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(texts)
        yield pa.RecordBatch.from_pydict(
            {"chunk": pa.array([task << 32 | k], pa.int64()), "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary())}
        )


def _score(order: int, least: int, backoff: float, total: int):
    def run(packed: pa.Table, counted: pa.Table) -> pa.Table:
        out: dict[str, list] = {name: [] for name in ("doc_id", "n_words", "n_backoff", "log_score")}
        if packed.num_rows:
            rows = pa.ipc.open_stream(packed["rows"][0].as_py()).read_all()
            hashes, firsts = hashed_words(rows["text"])
            counts, ends = [], []
            counted = counted.sort_by([("n", "ascending"), ("place", "ascending")])
            for n in range(1, order + 1):
                grams, end = chunk_grams(hashes, firsts, n)
                distinct, place = np.unique(grams, return_inverse=True)
                part = counted.filter(pc.equal(counted["n"], n))
                known, at = [], 0
                for row in part.select(["check_sum", "counts"]).to_pylist():
                    # The width follows from the sum of the hashes, which only the right number matches.
                    for kind in (np.uint32, np.uint64):
                        found = np.frombuffer(row["counts"], kind)
                        if check_sum(distinct[at : at + len(found)]) == row["check_sum"]:
                            break
                    else:
                        raise RuntimeError("a chunk has other n-grams than before: the input changed between two reads")
                    known.append(found.astype(np.int64))
                    at += len(found)
                if at != len(distinct):
                    raise RuntimeError("a chunk has other n-grams than before: the input changed between two reads")
                counts.append(np.concatenate(known or [np.zeros(0, np.int64)])[place])
                ends.append(end)
            logs, cut = backoff_logs(counts, ends, len(hashes), total, least, backoff)
            cuts = np.concatenate([[0], np.cumsum(cut > 0)])
            out["doc_id"] = rows["doc_id"].to_pylist()
            out["n_words"] = np.diff(firsts)
            out["n_backoff"] = cuts[firsts[1:]] - cuts[firsts[:-1]]
            out["log_score"] = [float(logs[a:b].sum()) for a, b in zip(firsts[:-1], firsts[1:])]
        return pa.table(
            {
                "doc_id": pa.array(out["doc_id"], pa.int64()),
                "n_words": pa.array(out["n_words"], pa.int64()),
                "n_backoff": pa.array(out["n_backoff"], pa.int64()),
                "log_score": pa.array(out["log_score"], pa.float64()),
            }
        )

    return run


def backoff_scores(
    documents: DataFrame, order: int = ORDER, least: int = LEAST_COUNT, backoff: float = BACKOFF
) -> DataFrame:
    """Each document's score: doc_id, n_words, n_backoff, mean_log_score.

    Words are runs of bytes other than white space.  A word scores the count of
    its n-gram over the count of the n-gram's context if the n-gram occurs at
    least `least` times in all documents, and `backoff` times its score with one
    context word less otherwise; a word by itself scores its share of all words.
    Documents count towards the tables they are scored with.  mean_log_score is
    the mean natural logarithm, rounded to six decimals; n_backoff counts the
    words that used less context than their text offers.

    A text without words, or a null one, has a null score.  Repeated rows are
    scored each, and counted each.  Other columns are not read; an empty table
    gives no rows.  documents must give the same partitions when read twice, as
    files and stored tables do; if it does not, the query fails.
    """
    if order < 1:
        raise ValueError("the order must be positive")
    spark = documents.sparkSession
    ship_package(spark)
    texts = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    total = texts.select("text").mapInArrow(_word_counts, "n long").agg(F.sum("n")).first()[0] or 0
    buckets = shuffle_partitions(spark)
    counted = (
        texts.mapInArrow(_explode(order, buckets), _GRAMS).groupBy("bucket", "n").applyInArrow(_count, _COUNTS)
    )
    packed = texts.mapInArrow(_pack, "chunk long, rows binary")
    scores = (
        packed.groupBy("chunk")
        .cogroup(counted.groupBy("chunk"))
        .applyInArrow(_score(order, least, backoff, total), _SCORES)
    )
    mean = F.round(F.col("log_score") / F.col("n_words"), 6)
    return scores.select(
        "doc_id", "n_words", "n_backoff", F.when(F.col("n_words") > 0, mean).alias("mean_log_score")
    )
