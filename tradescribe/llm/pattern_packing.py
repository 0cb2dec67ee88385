"""Best-fit packing of token sequences by patterns of lengths.

The number of pieces of each length is all that packing needs, and there are at
most `capacity` lengths.  So the driver plans on the histogram, whatever the size
of the corpus:

1. Lengths are rounded up to a coarse grid.  All patterns of at most three grid
   lengths that fill a sequence are enumerated, and non-negative least squares
   fits how often each is used to the coarse histogram.
2. Repeat counts are rounded, and each pattern is filled with real lengths, long
   ones beside short ones; the last place takes the length that fills the
   sequence, and where there is none the pieces are residual.
3. The residual is packed by best fit in decreasing length, whole runs of equal
   lengths at a time.

The plan says which sequences take the pieces numbered i to j of a length, and
every piece finds its place from its number within its length.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, functions as F

from tradescribe.llm.byte_bpe import ByteBpe, byte_bpe
from tradescribe.llm.tables import numbered, release_memory, ship_package, stored

CAPACITY = 2048
GRID = 16
END_OF_TEXT = 0
# The one added token of the file of the tokenizers library.
SPECIAL_TEXT, SPECIAL_ID = "<|endoftext|>", 50256
# How much of the fitted counts the patterns take; best fit needs some of all lengths to finish with.
PATTERN_SHARE = 0.75


def fill_patterns(cells: int, most: int = 3) -> list[tuple[int, ...]]:
    """All ways to write the number of grid cells as at most `most` lengths, longest first."""
    found: list[tuple[int, ...]] = []

    def extend(prefix: tuple[int, ...], left: int, longest: int) -> None:
        if not left:
            found.append(prefix)
        elif len(prefix) < most:
            for length in range(min(left, longest), 0, -1):
                if length * (most - len(prefix)) < left:
                    break
                extend((*prefix, length), left - length, length)

    extend((), cells, cells)
    return found


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 2_000) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by an active set (Lawson and Hanson)."""
    n = a.shape[1]
    x = np.zeros(n)
    active = np.zeros(n, dtype=bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(b).sum()))
    for _ in range(rounds):
        gradient = a.T @ (b - a @ x)
        gradient[active] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= tolerance:
            break
        active[best] = True
        while True:
            on = np.flatnonzero(active)
            solution = np.linalg.lstsq(a[:, on], b, rcond=None)[0]
            if solution.min() > 0:
                x[:] = 0
                x[on] = solution
                break
            falling = solution <= 0
            start = x[on][falling]
            step = np.min(start / np.maximum(start - solution[falling], 1e-300))
            x[on] += step * (solution - x[on])
            gone = on[falling & (x[on] <= 1e-9 * max(1.0, x.max()))]
            if not len(gone):
                gone = on[falling][:1]
            active[gone] = False
            x[~active] = 0
            if not active.any():
                break
    return x


class Plan:
    """Groups of equal sequences: lengths in order, and how many sequences have them."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.groups: list[tuple[tuple[int, ...], int]] = []
        # Open groups by free room, tightest first.
        self._rooms: list[int] = []
        self._open: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def _add(self, lengths: tuple[int, ...], count: int) -> None:
        room = self.capacity - sum(lengths)
        if room == 0:
            self.groups.append((lengths, count))
            return
        if room not in self._open:
            bisect.insort(self._rooms, room)
            self._open[room] = []
        self._open[room].append((lengths, count))

    def _take(self, room: int, most: int) -> tuple[tuple[int, ...], int]:
        lengths, count = self._open[room].pop()
        if count > most:
            self._open[room].append((lengths, count - most))
            count = most
        if not self._open[room]:
            del self._open[room]
            self._rooms.remove(room)
        return lengths, count

    def new(self, lengths: tuple[int, ...], count: int) -> None:
        if count:
            self._add(lengths, count)

    def best_fit(self, length: int, count: int) -> None:
        """Put `count` pieces into the tightest rooms that hold them, opening sequences where none does."""
        while count:
            i = bisect.bisect_left(self._rooms, length)
            if i == len(self._rooms):
                # Only equal lengths are left to share the new sequences: as many to each as fit.
                whole = self.capacity // length
                if count >= whole:
                    self._add((length,) * whole, count // whole)
                    count %= whole
                else:
                    self._add((length,) * count, 1)
                    count = 0
                continue
            lengths, n = self._take(self._rooms[i], count)
            self._add((*lengths, length), n)
            count -= n

    def close(self) -> list[tuple[tuple[int, ...], int]]:
        for groups in self._open.values():
            self.groups += groups
        merged = Counter()
        for lengths, count in self.groups:
            merged[tuple(sorted(lengths, reverse=True))] += count
        return sorted(merged.items(), reverse=True)


def _runs(left: np.ndarray, low: int, high: int, n: int, longest_first: bool) -> list[tuple[int, int]]:
    """Take n pieces with lengths from low to high; (length, count) runs."""
    lengths = range(high, low - 1, -1) if longest_first else range(low, high + 1)
    out = []
    for length in lengths:
        taken = min(n, int(left[length]))
        if taken:
            left[length] -= taken
            out.append((length, taken))
            n -= taken
        if not n:
            break
    return out


def _side_by_side(rows: list[tuple[tuple[int, ...], int]], runs: list[tuple[int, int]]) -> list[tuple[tuple[int, ...], int]]:
    out, i, used = [], 0, 0
    for lengths, count in rows:
        while count:
            length, n = runs[i]
            taken = min(count, n - used)
            out.append(((*lengths, length), taken))
            count -= taken
            used += taken
            if used == n:
                i, used = i + 1, 0
    return out


def packing_plan(histogram: np.ndarray, capacity: int, grid: int = GRID) -> list[tuple[tuple[int, ...], int]]:
    """Groups of sequences that hold every piece of the histogram (histogram[l] pieces of length l) once."""
    left = histogram.astype(np.int64).copy()
    if len(left) != capacity + 1 or left[0]:
        raise ValueError("lengths must be from 1 to the capacity")
    plan = Plan(capacity)
    plan.new((capacity,), int(left[capacity]))
    left[capacity] = 0
    grid = grid if capacity % grid == 0 else 1
    cells = capacity // grid
    patterns = [p for p in fill_patterns(cells) if len(p) > 1]
    if patterns and left.any():
        cell = np.zeros(cells + 1)
        np.add.at(cell, (np.arange(capacity + 1) + grid - 1) // grid, left)
        matrix = np.zeros((cells + 1, len(patterns)))
        for k, pattern in enumerate(patterns):
            for length in pattern:
                matrix[length, k] += 1
        repeats = np.floor(PATTERN_SHARE * nonnegative_least_squares(matrix, cell) + 0.5).astype(np.int64)
        for k in np.argsort(-repeats, kind="stable"):
            pattern, n = patterns[k], int(repeats[k])
            if not n:
                break
            for length, times in Counter(pattern).items():
                held = int(left[(length - 1) * grid + 1 : length * grid + 1].sum())
                n = min(n, held // times)
            if not n:
                continue
            rows: list[tuple[tuple[int, ...], int]] = [((), n)]
            for place, length in enumerate(pattern):
                if place + 1 == len(pattern):
                    # The last place takes what fills the room exactly; the rest is residual.
                    for lengths, count in rows:
                        room = capacity - sum(lengths)
                        taken = min(count, int(left[room]))
                        left[room] -= taken
                        plan.new((*lengths, room), taken)
                        for other in lengths:
                            left[other] += count - taken
                else:
                    runs = _runs(left, (length - 1) * grid + 1, length * grid, n, longest_first=place % 2 == 0)
                    rows = _side_by_side(rows, runs)
    for length in range(capacity, 0, -1):
        plan.best_fit(length, int(left[length]))
    return plan.close()


def plan_ranges(plan: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Where pieces go: piece number `first` and on of a length, to sequence `sequence` and on, at `offset`."""
    rows: list[tuple[int, int, int, int]] = []
    used: Counter = Counter()
    sequence = 0
    for lengths, count in plan:
        offset = 0
        for length in lengths:
            rows.append((length, used[length], sequence, offset))
            used[length] += count
            offset += length
        sequence += count
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return {name: table[:, i] for i, name in enumerate(("length", "first", "sequence", "offset"))}


def encoded_ids(bpe: ByteBpe, text: str) -> list[int]:
    """The ids that the tokenizers library gives: its special token splits the text and is one id."""
    parts = text.split(SPECIAL_TEXT)
    ids = bpe.encode(parts[0])
    for part in parts[1:]:
        ids += [SPECIAL_ID, *bpe.encode(part)]
    return ids


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_points(n: int, capacity: int) -> list[int]:
    """Starts of a document's pieces: only the first may be shorter than the capacity."""
    return [0, *range(n % capacity or capacity, n, capacity)]


def _pieces(path: str, pattern: str, capacity: int, special: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            columns: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(ids, texts):
                own = encoded_ids(bpe, text) if special else bpe.encode(text)
                tokens = np.array([*own, END_OF_TEXT], dtype="<u4")
                cuts = cut_points(len(tokens), capacity)
                for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(tokens)])):
                    for column, value in zip(columns, (doc_id, k, a, b - a, zlib.crc32(tokens[a:b].tobytes()))):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return run


def _places(ranges):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranges.value
        key = table["length"] << 40 | table["first"]
        for batch in batches:
            length, number = batch["length"].to_numpy(), batch["number"].to_numpy()
            at = np.searchsorted(key, length << 40 | number, side="right") - 1
            sequence = table["sequence"][at] + number - table["first"][at]
            yield pa.RecordBatch.from_arrays(
                [*(batch[name] for name in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(table["offset"][at])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def packed(
    documents: DataFrame,
    capacity: int = CAPACITY,
    ranks: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """Every piece of every document and its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its text's ids, then id 0.  Only one longer than the capacity
    is cut; all its pieces but the first are of full length.  The ranks hold the
    same vocabulary as the file of the tokenizers library, whose added token
    <|endoftext|> is recognised as there, and so give its ids.  Other ranks have
    no special token.

    A null text counts as empty and is the one id 0.  Repeated rows are packed
    each.  Other columns are not read; an empty table gives no rows.
    """
    if not 1 <= capacity < 1 << 20:
        raise ValueError("the capacity must be from 1 to 2^20 - 1")
    spark = documents.sparkSession
    ship_package(spark)
    path = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    texts = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    pieces = stored(texts.mapInArrow(_pieces(path, pattern, capacity, special=ranks is None), _PIECES), "packing-pieces")
    # One row for each length, so at most `capacity` of them.
    lengths = pieces.groupBy("length").count().toArrow()
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    histogram[lengths["length"].to_numpy()] = lengths["count"].to_numpy()
    ranges = spark.sparkContext.broadcast(plan_ranges(packing_plan(histogram, capacity)))
    ranked = numbered(pieces, ["length"], ["doc_id", "piece", "start", "ids_crc32"], "number")
    return ranked.mapInArrow(_places(ranges), f"{_PIECES}, sequence_id long, offset long")
