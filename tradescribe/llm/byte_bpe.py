"""Byte-level BPE over overlapping chunks, and its inverse.

A text is cut into chunks that overlap.  Each chunk is split into pre-tokens by
itself, as if a pre-token began at its first character.  The pattern looks back
at nothing, so once two chunks share a boundary they share all later ones: the
texts are stitched at the first boundary that both chunks have.  Every pre-token
is then encoded by itself.

Chunks of a text go to different tasks; only their ids come back to one row per
text.  A text of one chunk needs no stitching and is encoded where it is read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F

from tradescribe.llm.tables import ship_package

RANKS_FILE = "byte_bpe_50k.tiktoken"
CHUNK = 16_384
OVERLAP = 512

Columns = Callable[["ByteBpe", list[list[int]]], dict[str, pa.Array]]


class ByteBpe:
    """Ranks of byte strings, the pattern of pre-tokens, and both directions."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token

    def encode(self, text: str) -> list[int]:
        """Pre-token by pre-token, without special tokens."""
        return self.encoding.encode_ordinary(text)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text)


@lru_cache(maxsize=4)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """One for each Python worker."""
    return ByteBpe(path, pattern)


def encode_chunk(bpe: ByteBpe, text: str, start: int, last: bool) -> tuple[list[int], list[int], list[int], str]:
    """Pre-tokens of a chunk: where each starts, how many ids it has, all ids, and the unsettled rest.

    A pre-token that touches the end of the window may go on beyond it, so it
    stays text, unless the window ends the document.
    """
    pieces = bpe.pieces(text)
    rest = "" if last or not pieces else pieces.pop()
    starts, counts, ids = [], [], []
    at = start
    for piece in pieces:
        own = bpe.encode(piece)
        starts.append(at)
        counts.append(len(own))
        ids += own
        at += len(piece)
    return starts, counts, ids, rest


def stitch(bpe: ByteBpe, chunks: list[dict]) -> list[int]:
    """The ids of a text from those of its chunks, in order.

    Pre-tokens are taken from one chunk until a boundary that the next chunk
    has as well.  Where the window ends before such a boundary, the text is
    pre-tokenised on from the last settled one, chunk by chunk, until there is one.
    """
    out: list[int] = []
    at = 0  # all before it is encoded; a true boundary
    carried = ""  # text from `at` on that no chunk before has settled
    for k, chunk in enumerate(chunks):
        starts = np.asarray(chunk["starts"], dtype=np.int64)
        counts = np.asarray(chunk["counts"], dtype=np.int64)
        cum = np.concatenate([[0], np.cumsum(counts)])
        ids = chunk["ids"]
        end_of_settled = chunk["start"] + chunk["length"] - len(chunk["rest"])
        bounds = np.append(starts, end_of_settled)
        i = int(np.searchsorted(bounds, at))
        last = k + 1 == len(chunks)
        if i == len(bounds) or bounds[i] != at:
            # Not in step: go on from `at` over this chunk's own text.
            own = bpe.decode(list(ids)).decode("utf-8") + chunk["rest"]
            text = carried + own[at + len(carried) - chunk["start"] :]
            known = set(bounds.tolist())
            pieces = bpe.pieces(text)
            settled = len(pieces) if last else len(pieces) - 1
            for piece in pieces[:settled]:
                out += bpe.encode(piece)
                at += len(piece)
                if at in known:
                    break
            else:
                carried = "".join(pieces[settled:])
                continue
            i = int(np.searchsorted(bounds, at))
        if last:
            out += ids[cum[min(i, len(counts))] :]
            break
        head = np.asarray(chunks[k + 1]["starts"], dtype=np.int64)
        head = np.append(head, chunks[k + 1]["start"] + chunks[k + 1]["length"] - len(chunks[k + 1]["rest"]))
        common = np.intersect1d(bounds[i:], head)
        until = int(common[0]) if len(common) else int(bounds[-1])
        j = int(np.searchsorted(bounds, until))
        out += ids[cum[i] : cum[j]]
        at = until
        carried = "" if len(common) else chunk["rest"]
    return out


def ids_of(bpe: ByteBpe, texts: list[list[int]]) -> dict[str, pa.Array]:
    return {"ids": pa.array(texts, pa.list_(pa.int32()))}


def digests_of(bpe: ByteBpe, texts: list[list[int]]) -> dict[str, pa.Array]:
    """Number of ids, and digests of the ids as text and of the bytes they decode to."""
    digest = lambda data: hashlib.sha256(data).hexdigest()
    return {
        "n_tokens": pa.array(map(len, texts), pa.int64()),
        "ids_sha256": pa.array([digest(" ".join(map(str, ids)).encode()) for ids in texts], pa.string()),
        "decoded_sha256": pa.array([digest(bpe.decode(ids)) for ids in texts], pa.string()),
    }


def _encode_short(path: str, pattern: str, columns: Columns):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [bpe.encode(text) for text in part["text"].to_pylist()]
                yield pa.RecordBatch.from_pydict({"doc_id": part["doc_id"], **columns(bpe, ids)})

    return run


def _cut(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                key, doc_id, text = (batch[name][at].as_py() for name in ("row_key", "doc_id", "text"))
                start = 0
                while True:
                    last = start + chunk + overlap >= len(text)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "row_key": pa.array([key], pa.int64()),
                            "doc_id": pa.array([doc_id], pa.int64()),
                            "start": pa.array([start], pa.int64()),
                            "window": pa.array([text[start : start + chunk + overlap]], pa.string()),
                            "last": pa.array([last]),
                        }
                    )
                    if last:
                        break
                    start += chunk

    return run


_WINDOWS = "row_key long, doc_id long, start long, window string, last boolean"
_CHUNKS = "row_key long, doc_id long, start long, length long, starts array<long>, counts array<int>, ids array<int>, rest string"


def _encode_chunks(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                rows = part.to_pylist()
                found = [encode_chunk(bpe, r["window"], r["start"], r["last"]) for r in rows]
                yield pa.RecordBatch.from_pydict(
                    {
                        "row_key": part["row_key"],
                        "doc_id": part["doc_id"],
                        "start": part["start"],
                        "length": pa.array([len(r["window"]) for r in rows], pa.int64()),
                        "starts": pa.array([f[0] for f in found], pa.list_(pa.int64())),
                        "counts": pa.array([f[1] for f in found], pa.list_(pa.int32())),
                        "ids": pa.array([f[2] for f in found], pa.list_(pa.int32())),
                        "rest": pa.array([f[3] for f in found], pa.string()),
                    }
                )

    return run


def _stitch(path: str, pattern: str, columns: Columns):
    def run(table: pa.Table) -> pa.Table:
        bpe = byte_bpe(path, pattern)
        chunks = sorted(table.to_pylist(), key=lambda row: row["start"])
        doc_id = pa.array([chunks[0]["doc_id"]], pa.int64())
        return pa.table({"doc_id": doc_id, **columns(bpe, [stitch(bpe, chunks)])})

    return run


def _encoded(
    documents: DataFrame, columns: Columns, schema: str, ranks: str | None, pattern: str, chunk: int, overlap: int
) -> DataFrame:
    if chunk < 1 or overlap < 1:
        raise ValueError("chunk and overlap must be positive")
    ship_package(documents.sparkSession)
    path = ranks or public_tokenizers.path(RANKS_FILE)
    rows = documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    one_chunk = F.char_length("text") <= chunk + overlap
    short = rows.where(one_chunk).mapInArrow(_encode_short(path, pattern, columns), f"doc_id long, {schema}")
    windows = (
        # Row numbers of a scan stay the same when a task runs again.
        rows.select(F.monotonically_increasing_id().alias("row_key"), "doc_id", "text")
        .where(~one_chunk)
        .mapInArrow(_cut(chunk, overlap), _WINDOWS)
        .repartition("row_key", "start")
    )
    stitched = (
        windows.mapInArrow(_encode_chunks(path, pattern), _CHUNKS)
        .groupBy("row_key")
        .applyInArrow(_stitch(path, pattern, columns), f"doc_id long, {schema}")
    )
    return short.unionAll(stitched)


def encoded(
    documents: DataFrame,
    ranks: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """(doc_id, ids array<int>) for each row of documents(doc_id, text).

    ranks is a file of ranks, as the tiktoken library reads them, at the same
    place on every executor.  chunk and overlap are in code points and change no
    result.  A null text has no ids, like an empty one; repeated rows give a row
    each; other columns are not read; an empty table gives no rows.
    """
    return _encoded(documents, ids_of, "ids array<int>", ranks, pattern, chunk, overlap)


def encoded_digests(
    documents: DataFrame,
    ranks: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """The same with digests in place of ids: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _encoded(documents, digests_of, schema, ranks, pattern, chunk, overlap)


def decoded(encoded_rows: DataFrame, ranks: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(doc_id, data binary): the raw bytes of the ids, one after the other; null ids give no bytes."""
    ship_package(encoded_rows.sparkSession)
    path = ranks or public_tokenizers.path(RANKS_FILE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            data = [bpe.decode(ids or []) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "data": pa.array(data, pa.binary())})

    return encoded_rows.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, data binary")
