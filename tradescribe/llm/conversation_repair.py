"""Repair of conversations whose turns were lost, emptied, cut, repeated or given to the wrong side.

A repaired conversation has the roles of the pattern (s?(ua)+)?.  The cheapest
edits are found depth first: an explicit stack of prefixes, a lower bound for
what the rows left will cost at least, the best whole repair so far as incumbent
(cost, audit), and for each node (row, state of the pattern) the best prefix seen
there, which any worse prefix loses against.  When the stack is empty, the
incumbent is proved the best.

The rows of all conversations are sorted together and cut by ranges, so one
conversation may lie in any number of tasks.  A conversation inside one task is
solved there.  A longer one comes in pieces, each solved for every pair of states
before and after it; pieces then combine in levels, which is associative.  Two
audits of the same rows and cost are never one the beginning of the other, as
each letter has its cost, so the least pieces make the least whole.  Only the
digest of the repaired text, a sequential one, streams a long conversation's
rows through one task; it holds the audit, one letter a row, and no rows.

A null role or text counts as one space, and as one space in the key of the damage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tradescribe.llm.tables import ship_package, stored

# Rows of one piece and bytes of its texts, at most; pieces combined at once.  No result depends on them.
PIECE_ROWS = 256
PIECE_BYTES = 4_000_000
TOGETHER = 32

# Costs are fixed values of the query's contract.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

_BLANKS = "\x20\t\n\x0b\x0c\r"

# States: nothing yet, after s, after u, after a.  The pattern ends in the first or the last.
_START, _S, _U, _A = range(4)
_STEP = {(_START, "s"): _S, (_START, "u"): _U, (_S, "u"): _U, (_A, "u"): _U, (_U, "a"): _A}
_ENDS = (_START, _A)
_STATES = range(4)

# A row as the search sees it: role initial (s, u, a or ?), must be deleted, is truncated, further copies.
Shape = tuple[str, bool, bool, int]
Repair = tuple[int, str]


def _edits(shape: Shape, state: int) -> list[tuple[int, str, int]]:
    """(cost, letters, next state) of every edit of a row; its further copies are deleted behind it."""
    initial, forced, truncated, more = shape
    found = [(DELETE, "D", state)]
    if not forced:
        cost = TRUNCATED if truncated else 0
        if (state, initial) in _STEP:
            found.append((cost, "K", _STEP[state, initial]))
        for side in "ua":
            if side != initial and (state, side) in _STEP:
                found.append((cost + REROLE, "R", _STEP[state, side]))
    if more:
        found = [(cost + DELETE * more, letters + "D" * more, after) for cost, letters, after in found]
    return found


def _inserts(state: int) -> list[tuple[int, str, int]]:
    return [(INSERT, "I", _STEP[state, side]) for side in "ua" if (state, side) in _STEP]


def suffix_bounds(shapes: tuple[Shape, ...]) -> list[list[int]]:
    """What the rows from i on cost at least, by the state before them; the pattern may end anywhere."""
    bounds = [[0] * 4]
    for shape in reversed(shapes):
        after = bounds[-1]
        own = [min(cost + after[to] for cost, _, to in _edits(shape, state)) for state in _STATES]
        for _ in range(2):  # at most two inserts in a row lead to another state
            own = [min([own[state], *(cost + own[to] for cost, _, to in _inserts(state))]) for state in _STATES]
        bounds.append(own)
    return bounds[::-1]


def best_repair(
    shapes: tuple[Shape, ...], entry: int = _START, ends: tuple[int, ...] = _ENDS, bounds: list[list[int]] | None = None
) -> Repair | None:
    """The cheapest (cost, audit) from a state before the rows to one of `ends` behind them, the least audit of these."""
    bounds = suffix_bounds(shapes) if bounds is None else bounds
    n = len(shapes)
    incumbent: Repair | None = None
    seen: dict[tuple[int, int], Repair] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        known = seen.get((i, state))
        if known is not None and known <= (cost, audit):
            continue
        if incumbent is not None:
            least = cost + bounds[i][state]
            if least > incumbent[0] or (least == incumbent[0] and audit > incumbent[1][: len(audit)]):
                continue
        seen[i, state] = (cost, audit)
        if i == n and state in ends and (incumbent is None or (cost, audit) < incumbent):
            incumbent = (cost, audit)
        nexts = [(own, letters, i, to) for own, letters, to in _inserts(state)]
        if i < n:
            nexts += [(own, letters, i + 1, to) for own, letters, to in _edits(shapes[i], state)]
        # The most promising is pushed last and so comes next.
        nexts.sort(key=lambda e: (e[0] + bounds[e[2]][e[3]], e[1]), reverse=True)
        stack += [(at, to, cost + own, audit + letters) for own, letters, at, to in nexts]
    return incumbent


@lru_cache(maxsize=20_000)
def _best_of_short(shapes: tuple[Shape, ...]) -> Repair:
    return best_repair(shapes)


def _best(shapes: tuple[Shape, ...]) -> Repair:
    return _best_of_short(shapes) if len(shapes) <= 16 else best_repair(shapes)


def all_repairs(shapes: tuple[Shape, ...]) -> list[Repair | None]:
    """The best repair for every state before (slow index) and after the rows."""
    bounds = suffix_bounds(shapes)
    return [best_repair(shapes, entry, (end,), bounds) for entry in _STATES for end in _STATES]


def combined(first: list[Repair | None], second: list[Repair | None]) -> list[Repair | None]:
    """The same for the rows of two neighbouring pieces."""
    out: list[Repair | None] = []
    for entry in _STATES:
        for end in _STATES:
            ways = [
                (a[0] + b[0], a[1] + b[1])
                for a, b in ((first[4 * entry + middle], second[4 * middle + end]) for middle in _STATES)
                if a is not None and b is not None
            ]
            out.append(min(ways, default=None))
    return out


def written(audit: str, rows: Iterator[tuple[str, str, int]]) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired conversation, from its rows (role, text, copies) in order."""
    length = len(audit) - audit.count("D")
    place = length % 2  # an odd length begins with s
    at = 0
    copies, role, text = 0, "", ""
    for letter in audit:
        if letter != "I":
            if not copies:
                role, text, copies = next(rows)
            copies -= 1
        if letter == "D":
            continue
        side = ("user", "assistant")[(at - place) % 2]
        at += 1
        yield (side, "") if letter == "I" else (side if letter == "R" else role, text)


# --- rows --------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, gone, turn, role, text: the rows after the damage, and dropped rows with gone set and nothing else."""
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)
    )
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("fate"),
    )
    fate, gone = F.col("fate"), F.col("fate") == 0
    return rows.select(
        "conv_id",
        gone.alias("gone"),
        F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(fate == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(gone | (fate == 1), "").when(fate == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(fate == 3, 2).otherwise(1).cast("long").alias("times"),
    )


def as_given(conversations: DataFrame) -> DataFrame:
    """The same columns for rows without damage."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.lit(False).alias("gone"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.lit(1).cast("long").alias("times"),
    )


def _ordered(rows: DataFrame) -> DataFrame:
    """Distinct rows with their copies, and whether an earlier turn has the same role and text, in order by ranges.

    Copies meet as partial counts.  Rows that occur in several turns are few or
    many; the join with their first turns is one that adaptive execution splits.
    """
    distinct = rows.groupBy("conv_id", "gone", "turn", "role", "text").agg(F.sum("times").alias("copies"))
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))
    key = F.concat_ws(":", conv, F.char_length("role").cast("string"), F.col("role"), F.col("text"))
    distinct = stored(distinct.withColumn("same", F.unhex(F.sha2(key.cast("binary"), 256))), "repair-rows")
    firsts = (
        distinct.where(~F.col("gone"))
        .groupBy("same")
        .agg(
            F.count(F.lit(1)).alias("turns"),
            F.min("turn").alias("first"),
            F.max(F.col("turn").isNull()).alias("without"),
        )
        .where(F.col("turns") > 1)
    )
    firsts = stored(firsts.select("same", "first", "without"), "repair-firsts")
    later = F.col("turn").isNotNull() & (F.col("without") | (F.col("turn") > F.col("first")))
    order = [F.asc("conv_id"), F.desc("gone"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    return (
        distinct.join(firsts, "same", "left")
        .select("conv_id", "gone", "turn", "role", "text", "copies", F.coalesce(later, F.lit(False)).alias("again"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )


# --- pieces ------------------------------------------------------------------

_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_HEAD = [
    ("conv_id", pa.int64()),
    ("part", pa.int64()),
    ("piece", pa.int64()),
    ("place", pa.int64()),  # of a row in an open piece, -1 for what tells of whole pieces
    ("closed", pa.bool_()),
]
_FACTS = [
    ("first_turn", pa.int64()),
    ("last_turn", pa.int64()),
    ("turns", pa.int64()),
    ("first_initial", pa.string()),
    ("last_initial", pa.string()),
    *((name, pa.int64()) for name in _COUNTS),
    ("costs", pa.list_(pa.int64())),
    ("audits", pa.list_(pa.string())),
]
_PIECES = pa.schema([*_HEAD, *_FACTS, ("repaired_sha256", pa.string()), ("role", pa.string()), ("text", pa.string()), ("copies", pa.int64())])
_TYPES = {pa.int64(): "long", pa.string(): "string", pa.bool_(): "boolean", pa.list_(pa.int64()): "array<long>", pa.list_(pa.string()): "array<string>"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{field.name} {_TYPES[field.type]}" for field in schema)


class Piece:
    """Neighbouring rows of one conversation."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, str, int]] = []
        self.shapes: list[Shape] = []
        self.bytes = 0
        self.facts = {"first_turn": None, "last_turn": None, "turns": 0, "first_initial": None, "last_initial": None}
        self.facts |= dict.fromkeys(_COUNTS, 0)

    def add(self, turn: int | None, role: str, text: str, copies: int, again: bool) -> None:
        facts = self.facts
        words = text.strip(_BLANKS)
        blank, truncated = not words, bool(words) and words[-1] not in ".!?"
        forced = blank or again
        initial = role[:1]
        if blank:
            facts["blank"] += copies
        else:
            facts["duplicate"] += copies - (not again)
            facts["truncated"] += truncated and not again
        if turn is not None:
            facts["turns"] += turn != facts["last_turn"]
            facts["first_turn"] = turn if facts["first_turn"] is None else facts["first_turn"]
            facts["last_turn"] = turn
        facts["illegal"] += copies - 1
        if facts["last_initial"] is not None:
            facts["illegal"] += facts["last_initial"] + initial not in ("su", "ua", "au")
        facts["first_initial"] = initial if facts["first_initial"] is None else facts["first_initial"]
        facts["last_initial"] = initial
        self.rows.append((role, text, copies))
        self.shapes.append((initial if initial and initial in "sua" else "?", forced, truncated and not forced, copies - 1))
        self.bytes += len(text)

    def full(self, most: int) -> bool:
        return len(self.rows) >= most or self.bytes >= PIECE_BYTES


def _digest(audit: str, rows: Iterator[tuple[str, str, int]]) -> str:
    out = hashlib.sha256()
    for i, (role, text) in enumerate(written(audit, rows)):
        out.update(f"{chr(10) if i else ''}{role}:{text}".encode())
    return out.hexdigest()


def _lines(head: dict, piece: Piece) -> list[dict]:
    return [head | {"place": i, "role": role, "text": text, "copies": n} for i, (role, text, n) in enumerate(piece.rows)]


def _closed(head: dict, piece: Piece, texts: bool) -> list[dict]:
    cost, audit = _best(tuple(piece.shapes))
    found = head | {"closed": True, "place": -1, "costs": [cost], "audits": [audit]} | piece.facts
    found["repaired_sha256"] = _digest(audit, iter(piece.rows))
    return [found, *(_lines(head, piece) if texts else [])]


def _open(head: dict, piece: Piece) -> list[dict]:
    found = all_repairs(tuple(piece.shapes))
    costs = [None if repair is None else repair[0] for repair in found]
    audits = [None if repair is None else repair[1] for repair in found]
    return [head | {"place": -1, "costs": costs, "audits": audits} | piece.facts, *_lines(head, piece)]


def _pieces(most: int, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole conversations solved, and the pieces and rows of those that may go on in another task."""
        part = TaskContext.get().partitionId()
        out: list[dict] = []
        waiting = 0
        conv, piece, number, first = None, None, 0, True

        def solved(more: bool) -> None:
            nonlocal waiting
            head = {"conv_id": conv, "part": part, "piece": number, "closed": False}
            # The first conversation of a task may have begun in another one.
            rows = _open(head, piece) if more or first or number else _closed(head, piece, texts)
            out.extend(rows)
            waiting += sum(len(row.get("text") or "") + 500 for row in rows)

        for batch in batches:
            columns = [batch[name].to_pylist() for name in ("conv_id", "gone", "turn", "role", "text", "copies", "again")]
            for own, gone, turn, role, text, copies, again in zip(*columns):
                if piece is not None and own != conv:
                    solved(False)
                    piece, number, first = None, 0, False
                elif piece is not None and piece.full(most):
                    solved(True)
                    piece, number = Piece(), number + 1
                if piece is None:
                    conv, piece = own, Piece()
                if not gone:
                    piece.add(turn, role, text, copies, again)
                if waiting > PIECE_BYTES:
                    yield pa.RecordBatch.from_pylist(out, _PIECES)
                    out, waiting = [], 0
        if piece is not None:
            solved(True)
        if out:
            yield pa.RecordBatch.from_pylist(out, _PIECES)

    return run


def joined_facts(first: dict, second: dict) -> dict:
    """What two neighbouring runs of rows tell together."""
    out = {name: first[name] + second[name] for name in _COUNTS}
    between = (first["last_initial"], second["first_initial"])
    out["illegal"] += None not in between and "".join(between) not in ("su", "ua", "au")
    same = first["last_turn"] is not None and first["last_turn"] == second["first_turn"]
    out["turns"] = first["turns"] + second["turns"] - same
    for name, a, b in (("first_turn", first, second), ("last_turn", second, first)):
        out[name] = b[name] if a[name] is None else a[name]
    for name, a, b in (("first_initial", first, second), ("last_initial", second, first)):
        out[name] = b[name] if a[name] is None else a[name]
    return out


_LEVEL = pa.schema([("conv_id", pa.int64()), ("id", pa.int64()), *_FACTS])


def _repairs_of(row: dict) -> list[Repair | None]:
    return [None if cost is None else (cost, audit) for cost, audit in zip(row["costs"], row["audits"])]


def _combine(group: pa.Table) -> pa.Table:
    rows = sorted(group.to_pylist(), key=lambda row: row["id"])
    facts, repairs = rows[0], _repairs_of(rows[0])
    for row in rows[1:]:
        facts, repairs = joined_facts(facts, row), combined(repairs, _repairs_of(row))
    costs = [None if repair is None else repair[0] for repair in repairs]
    audits = [None if repair is None else repair[1] for repair in repairs]
    whole = facts | {"conv_id": rows[0]["conv_id"], "id": rows[0]["id"] // TOGETHER, "costs": costs, "audits": audits}
    return pa.Table.from_pylist([whole], _LEVEL)


def _whole(pieces: DataFrame) -> DataFrame:
    """One row for each conversation that came in pieces, combined in levels of at most TOGETHER rows."""
    heads = pieces.where(~F.col("closed") & (F.col("place") < 0))
    most = heads.agg(F.max("piece"), F.max("part")).first()
    numbers = (most[0] or 0) + 1
    level = heads.withColumn("id", F.col("part") * numbers + F.col("piece")).select(*_LEVEL.names)
    left = numbers * ((most[1] or 0) + 1)
    while left > 1:
        level = stored(
            level.withColumn("_group", F.floor(F.col("id") / TOGETHER))
            .groupBy("conv_id", "_group")
            .applyInArrow(_combine, _ddl(_LEVEL)),
            "repair-level",
        )
        left = -(-left // TOGETHER)
    return level


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations that came in pieces: each begins with its combined row and goes on with its rows in order."""
    held = _Stream(batches)
    for head in held:
        found = _repairs_of(head)
        # All pairs of states; nothing precedes the conversation.
        cost, audit = min(found[end] for end in _ENDS if found[end] is not None)
        whole = head | {"costs": [cost], "audits": [audit], "closed": True}
        whole["repaired_sha256"] = _digest(audit, held.rows())
        yield pa.RecordBatch.from_pylist([whole], _PIECES)


_TURNS = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired rows of conversations that begin with their closed row."""
    held = _Stream(batches)
    out: list[dict] = []
    for head in held:
        for position, (role, text) in enumerate(written(head["audits"][0], held.rows())):
            out.append({"conv_id": head["conv_id"], "position": position, "role": role, "text": text})
            if len(out) >= 1_000:
                yield pa.RecordBatch.from_pylist(out, _TURNS)
                out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, _TURNS)


class _Stream:
    """Rows of batches one by one, with a look at the next."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        self._rows = (row for batch in batches for row in batch.to_pylist())
        self._next = next(self._rows, None)

    def _pop(self) -> dict:
        row, self._next = self._next, next(self._rows, None)
        return row

    def __iter__(self) -> Iterator[dict]:
        while self._next is not None:
            row = self._pop()
            if row["place"] < 0:  # rows that the last conversation's audit did not ask for are behind it
                yield row

    def rows(self) -> Iterator[tuple[str, str, int]]:
        while self._next is not None and self._next["place"] >= 0:
            row = self._pop()
            yield row["role"], row["text"], row["copies"]


_ORDER = ["conv_id", "part", "piece", "place"]


def _in_order(heads: DataFrame, lines: DataFrame) -> DataFrame:
    """Each conversation's own row and then its rows, together in one task."""
    first = heads.withColumns({name: F.lit(-1).cast("long") for name in _ORDER[1:]}).select(*_PIECES.names)
    return first.unionByName(lines).repartition("conv_id").sortWithinPartitions(*_ORDER)


def _solved(rows: DataFrame, piece_rows: int, texts: bool = False) -> tuple[DataFrame, DataFrame]:
    """All conversations as closed rows, and their ordered rows; without `texts`, only of those that came in pieces."""
    ship_package(rows.sparkSession)
    pieces = stored(_ordered(rows).mapInArrow(_pieces(piece_rows, texts), _ddl(_PIECES)), "repair-pieces")
    others = [F.lit(None).cast(_TYPES[kind]).alias(name) for name, kind in zip(_PIECES.names, _PIECES.types) if name not in _LEVEL.names]
    lines = pieces.where(F.col("place") >= 0)
    whole = _whole(pieces).select(*_LEVEL.names, *others)
    in_pieces = lines.join(whole.select("conv_id"), lines.conv_id.eqNullSafe(whole.conv_id), "left_semi") if texts else lines
    finished = _in_order(whole, in_pieces).mapInArrow(_finished, _ddl(_PIECES))
    return pieces.where("closed").unionByName(finished), lines


def repairs(conversations: DataFrame, damage: bool = False, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Each conversation's faults and cheapest repair: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Turns are ordered by turn, nulls first, then by role and text.  With
    `damage`, rows are first damaged as the query asks.  A null conv_id is one
    conversation, a null role or text one space.  Repeated rows are duplicates;
    a conversation without rows after damage has zeros, an empty audit and the
    digest of the empty string; other columns are not read; an empty table gives no rows.
    """
    whole, _ = _solved(damaged(conversations) if damage else as_given(conversations), piece_rows)
    gaps = F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns")
    return whole.select(
        "conv_id",
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"),
        *_COUNTS,
        F.col("costs")[0].alias("cost"),
        F.col("audits")[0].alias("audit"),
        "repaired_sha256",
    )


def repaired(conversations: DataFrame, damage: bool = False, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The rows of the repaired conversations: conv_id, position (from 0), role, text.

    Odd input as for `repairs`; a conversation that is repaired to nothing has no rows.
    """
    whole, lines = _solved(damaged(conversations) if damage else as_given(conversations), piece_rows, texts=True)
    return _in_order(stored(whole, "repair-whole"), lines).mapInArrow(_turns, _ddl(_TURNS))
