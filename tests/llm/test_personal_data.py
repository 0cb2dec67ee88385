"""Personal data: fixed kinds against plain patterns, learned kinds on texts whose personal data are known."""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pytest

from tests.llm.tables import no_documents, odd_documents
from tradescribe.llm import personal_data as pd_
from tradescribe.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
# The contract's patterns, as they stand.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def slow_luhn(digits):
    total = 0
    for place, digit in enumerate(digits[::-1]):
        total += sum(map(int, str(int(digit) * 2))) if place % 2 else int(digit)
    return total % 10 == 0


def slow_spans(text):
    out = []
    for place, (kind, pattern) in enumerate(PLAIN.items()):
        for found in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", found.group())
            if kind == "ip" and any(int(part) > 255 for part in found.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and slow_luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((found.start(), place, found.end(), kind))
    return [(a, b, kind) for a, _, b, kind in sorted(out)]


PIECES = ["a@b.c", "x.y+z@mail-1.example.com", "@", "@@", "a@b", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "007.0.00.255", ".", "..", "4845168114407329",
          "4111 1111-1111 1111", "4111  1111", "+1 (017) 555-7713", "+49 30 1234567", "+1", "+12345678901234567", " ", "-", "é", "🙂", "word", "_", "%", "12"]


@pytest.mark.parametrize("seed", range(4))
def test_fixed_kinds_against_plain_patterns(seed):
    rng = random.Random(seed)
    for _ in range(4_000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 9)))
        assert pd_.base_spans(text) == slow_spans(text), text
    for _ in range(4_000):
        text = "".join(rng.choice("0123456789.+ -@a(") for _ in range(rng.randrange(0, 40)))
        assert pd_.base_spans(text) == slow_spans(text), text


@pytest.mark.parametrize("text", ["x" * 400_000, "1" * 400_000, "1." * 200_000, "a@" * 200_000, "+1 " * 130_000, "((((" * 100_000, "Aa " * 130_000, "1 " * 200_000, "AB12" * 100_000, "12 Aa " * 70_000])
def test_very_long_texts_take_linear_time(text):
    start = time.perf_counter()
    found = pd_._found(text)
    assert time.perf_counter() - start < 6, len(found[1])


def check(df, rows):
    out = {}
    expected = Counter((d, slow_key(t)) for d, t in rows)
    actual = Counter()
    for r in df.collect():
        assert df.columns[:7] == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
        actual[r.doc_id, (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256)] += 1
        out[r.doc_id] = r.spans
    assert actual == expected
    return out


def slow_key(text):
    spans = slow_spans(text)
    listed = ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)
    return *[sum(s[2] == kind for s in spans) for kind in PLAIN], hashlib.sha256(listed.encode()).hexdigest()


def test_query_against_plain_patterns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    spans = check(QUERIES["op12_personal_data"](spark, SF_DIR), rows)
    for doc_id, text in rows:
        base = {f"{k}:{a}:{b}" for a, b, k in slow_spans(text)}
        assert base <= set(spans[doc_id].split(","))


def test_odd_and_empty_documents(spark):
    docs = odd_documents(spark)
    check(pd_.personal_data(docs), [(r.doc_id, r.text) for r in docs.collect()])
    assert pd_.personal_data(no_documents(spark)).collect() == []
    assert pd_.masked(no_documents(spark)).columns == no_documents(spark).columns


# --- learned kinds ---------------------------------------------------------------

FIRST = ["Anna", "Peter", "Maria", "Thomas", "Juan", "Claire", "Zyra", "Qorin"]
LAST = ["Miller", "Weber", "Lopez", "Dubois", "Tarkin", "Ostrom", "Velling"]
THINGS = ["Silver Lake", "Golden Gate", "Green Valley", "Royal Court", "Blue Ridge"]


def known_text(rng):
    """A text and its personal data (kind, string)."""
    name = f"{rng.choice(FIRST)} {rng.choice(LAST)}"
    tel = f"({rng.randrange(200, 999)}) {rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"
    day = f"{rng.randrange(1, 29)}.{rng.randrange(1, 13)}.{rng.randrange(1930, 2005)}"
    home = f"{rng.randrange(1, 200)} {rng.choice(['Oak', 'Maple', 'Hill'])} {rng.choice(['Street', 'Road', 'Lane'])}"
    choices = [
        (f"Yesterday we met mr {name} and talked.", [("name", name)]),
        (f"it was {name} who said so.", [("name", name)] if name.split()[0].lower() in pd_._GIVEN else []),
        (f"please call {tel} tonight.", [("number", tel)]),
        (f"our phone is {tel} as ever.", [("number", tel)]),
        (f"she was born {day} here.", [("birth", day)]),
        (f"he lives at {home} now.", [("address", home)]),
        (f"the walk to {rng.choice(THINGS)} was long.", []),
        (f"the order {rng.randrange(10**8, 10**9)} was late.", []),
        (f"a total of {rng.randrange(10**7, 10**8)}% is wrong.", []),
        (f"it was dated {day} and lost.", []),
        ("the walk in March was long.", []),
    ]
    parts, found = [], []
    for text, own in rng.choices(choices, k=6):
        parts.append(text)
        found += own
    return " ".join(parts), found


def test_learned_spans_on_held_out_texts(spark):
    rng = random.Random(8)
    learn = [known_text(rng) for _ in range(600)]
    model = pd_.fit(pd_.scanned(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(learn)], "doc_id long, text string")))
    right = wrong = missed = 0
    for _ in range(400):
        text, expected = known_text(rng)
        _, found = pd_._found(text)
        own = Counter((kind, text[a:b]) for a, b, kind in model.accepted([(c["kind"], c["start"], c["end"], c["features"]) for c in found]))
        right += sum((own & Counter(expected)).values())
        wrong += sum((own - Counter(expected)).values())
        missed += sum((Counter(expected) - own).values())
    assert right / (right + wrong) > 0.93 and right / (right + missed) > 0.93, (right, wrong, missed)


def test_masking(spark):
    docs = spark.createDataFrame([(1, "write to a@b.example or phone +1 (017) 555-7713."), (2, None)], "doc_id long, text string")
    assert [r.text for r in pd_.masked(docs).orderBy("doc_id").collect()] == ["write to [email] or phone [phone].", None]


def test_expectation_maximisation_finds_the_bad_labeler():
    """Votes drawn from known reliabilities: the estimates come near them."""
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.4
    right = [0.95, 0.9, 0.6, 0.85]
    votes = np.stack([np.where(rng.random(20_000) < p, 1, -1) * np.where(truth, 1, -1) * (rng.random(20_000) < 0.7) for p in right], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    found = pd_.reliabilities(patterns, counts.astype(float))
    assert np.abs(found.right - right).max() < 0.04
    guess = found.probability(votes) > 0.5
    assert (guess == truth)[(votes != 0).any(axis=1)].mean() > 0.93


def test_more_candidates_than_the_sample(spark):
    rng = random.Random(9)
    rows = [(i, known_text(rng)[0]) for i in range(300)]
    scan = pd_.scanned(spark.createDataFrame(rows, "doc_id long, text string"))
    few, again = pd_.fit(scan, 60), pd_.fit(scan, 60)
    assert set(few.weights) and all((few.weights[k] == again.weights[k]).all() for k in few.weights)
