"""Conversation repair against enumeration of all edits and against the query's SQL, on hard tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from tests.compare import differences, duck
from tradescribe.llm import conversation_repair as cr
from tradescribe.llm.queries import QUERIES, STATEMENTS

SCHEMA = "conv_id long, turn long, role string, text string, part long, cost double, audit string"
EMPTY = hashlib.sha256(b"").hexdigest()


def odd_conversations(spark):
    """Nulls in every column, ties, repeated rows, gaps, many turns, odd roles and columns with clashing names."""
    rng = random.Random(3)
    texts = ["Yes.", "No!", "Why?", "cut", "", " \t", None, "é.", "x" * 5_000 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(0, 9)):
            role = rng.choice(roles) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            text = rng.choice(texts) if rng.random() < 0.4 else f"Text {conv} {turn}."
            rows.append((conv, turn if rng.random() < 0.9 else rng.choice([None, 0, 3]), role, text))
    rows += [(None, None, None, None), (None, 1, "user", "Hm."), (None, 1, "user", "Hm.")] + [rows[0]] * 5
    rows += [(1000, i // 2, ("user", "assistant")[i % 3 % 2], rng.choice(["Same.", f"Number {i}.", "cut"])) for i in range(700)]
    rows += [(1001, None, "user", "Again.")] * 40
    return spark.createDataFrame([r + (7, 0.5, "x") for r in rows], SCHEMA)


def by_conversation(rows, damage):
    """Rows after damage, in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv]
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return {c: sorted(r, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for c, r in out.items()}


def slow_repair(rows):
    """All edits of each row, with up to two inserted rows before each and at the end, by plain recursion over suffixes."""
    seen, forced, cut = set(), [], []
    for _, role, text in rows:
        words = text.strip("\x20\t\n\x0b\x0c\r")
        forced.append(not words or (role, text) in seen)
        cut.append(bool(words) and words[-1] not in ".!?")
        seen.add((role, text))

    def grows(initials, initial):
        """The pattern (s?(ua)+)? may begin so, told by its last letter."""
        return initial in {"": "su", "s": "u", "u": "a", "a": "u"}[initials]

    @lru_cache(None)
    def rest(i, last, inserted):
        ways = [(0, "")] if i == len(rows) and last in ("", "a") else []
        if i < len(rows):
            _, role, _ = rows[i]
            edits = [("D", 2, last)]
            if not forced[i]:
                extra = 5 if cut[i] else 0
                edits += [("K", extra, role[:1])] if role[:1] and grows(last, role[:1]) else []
                edits += [("R", 1 + extra, side) for side in "ua" if grows(last, side)]
            for letter, cost, now in edits:
                ways += [(cost + c, letter + a) for c, a in [rest(i + 1, now, 0)] if c is not None]
        if inserted < 2:
            ways += [(5 + c, "I" + a) for side in "ua" if grows(last, side) for c, a in [rest(i, side, inserted + 1)] if c is not None]
        return min(ways, default=(None, ""))

    cost, audit = rest(0, "", 0)
    length, at, out, own = sum(x != "D" for x in audit), 0, [], iter(rows)
    for letter in audit:
        row = None if letter == "I" else next(own)
        if letter != "D":
            side = ("user", "assistant")[(at - length % 2) % 2]
            out.append((side, "") if letter == "I" else (side if letter == "R" else row[1], row[2]))
            at += 1
    return cost, audit, out


def slow(rows, damage):
    found, turns_of = {}, {}
    for conv, own in by_conversation(rows, damage).items():
        cost, audit, out = slow_repair(own)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, blank, duplicate, truncated = set(), 0, 0, 0
        for _, role, text in own:
            words = text.strip("\x20\t\n\x0b\x0c\r")
            if not words:
                blank += 1
            elif (role, text) in seen:
                duplicate += 1
            elif words[-1] not in ".!?":
                truncated += 1
            seen.add((role, text))
        initials = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        found[conv] = (gaps, blank, duplicate, truncated, illegal, cost, audit, digest)
        turns_of[conv] = out
    return found, turns_of


@pytest.mark.parametrize("piece_rows, damage", [(256, True), (3, True), (1, False)])
def test_repairs_against_brute_force(spark, piece_rows, damage):
    df = odd_conversations(spark)
    expected, turns = slow([tuple(r)[:4] for r in df.collect()], damage)
    actual = cr.repairs(df, damage, piece_rows).collect()
    assert len(actual) == len(expected)
    assert {r.conv_id: tuple(r)[1:] for r in actual} == expected
    out = defaultdict(dict)
    for r in cr.repaired(df, damage, piece_rows).collect():
        out[r.conv_id][r.position] = (r.role, r.text)
    assert {c: [rows[i] for i in range(len(rows))] for c, rows in out.items()} == {c: t for c, t in turns.items() if t}


def test_search_finds_the_least_audit_of_the_cheapest():
    rng = random.Random(1)
    for _ in range(1_500):
        shapes = tuple(
            (rng.choice("suaua?"), rng.random() < 0.2, rng.random() < 0.2, 0) for _ in range(rng.randrange(0, 9))
        )
        rows = []
        for i, (initial, forced, cut, _) in enumerate(shapes):
            rows.append((i, initial, " " if forced else f"{i}" if cut else f"{i}."))
        shapes = tuple((a, f, c and not f, n) for a, f, c, n in shapes)
        assert cr.best_repair(shapes) == slow_repair(rows)[:2]
        cut = rng.randrange(0, len(shapes) + 1)
        both = cr.combined(cr.all_repairs(shapes[:cut]), cr.all_repairs(shapes[cut:]))
        assert both == cr.all_repairs(shapes)


def test_bounds_never_exceed_the_cost():
    rng = random.Random(2)
    for _ in range(300):
        shapes = tuple((rng.choice("sua?"), False, rng.random() < 0.3, rng.randrange(3)) for _ in range(6))
        bounds = cr.suffix_bounds(shapes)
        for i in range(7):
            for entry in range(4):
                for end in range(4):
                    found = cr.best_repair(shapes[i:], entry, (end,))
                    assert found is None or bounds[i][entry] <= found[0]


def test_long_conversation_is_searched_in_little_time():
    rng = random.Random(4)
    shapes = tuple((rng.choice("ua"), rng.random() < 0.1, rng.random() < 0.1, 0) for _ in range(3_000))
    cost, audit = cr.best_repair(shapes)
    assert len(audit) - audit.count("I") == 3_000 and cost > 0


def test_conversations_without_rows(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Yes.", 1, 0.5, "x")], SCHEMA)
    assert [tuple(r) for r in cr.repairs(df, True).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", EMPTY)]
    assert cr.repairs(spark.createDataFrame([], SCHEMA), True).collect() == []
    assert cr.repaired(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_equals_its_statement(spark):
    sf = "/root/testdata/sf0.001"
    name = "op11_conversation_repair"
    assert not differences(QUERIES[name](spark, sf), duck(sf), STATEMENTS[name])
