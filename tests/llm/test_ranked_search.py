"""Ranked search against brute force and the query's SQL."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from urllib.parse import unquote

import numpy as np
import pyarrow.parquet as pq
import pytest

from tests.compare import differences, duck
from tests.llm.tables import no_documents, odd_documents
from tradescribe.llm import ranked_search as rs
from tradescribe.llm.queries import QUERIES, STATEMENTS
from tradescribe.llm.tables import bounded_batches

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def slow_search(docs, items, most=10):
    """docs: (doc_id, text), items: (item_id, text)."""
    bags = [(doc_id, Counter(slow_terms(text))) for doc_id, text in docs]
    bags = [(doc_id, bag) for doc_id, bag in bags if bag]
    total, held = len(bags), Counter(term for _, bag in bags for term in bag)
    length = sum(sum(bag.values()) for _, bag in bags)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, bag in bags:
            m, score = 100 - 75 + (75 * sum(bag.values()) * total) // length, 0
            for term in slow_terms(text):
                if term in bag:
                    w = math.floor(1000 * math.log((2 * total + 2) / (2 * held[term] + 1)))
                    score += w * ((1000000000 * bag[term]) // (1000 * bag[term] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [
            (item_id, rank, None if none else doc_id, -score)
            for rank, (score, none, doc_id) in enumerate(sorted(scored)[:most], 1)
        ]
    return Counter(out)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, digest string, rank int, doc_id long, score long")


def odd_items(spark, docs):
    texts = [r.text for r in docs.select("text").collect()]
    rows = [(i, text) for i, text in enumerate(texts)]
    rows += [(90, "w1 W1 w2 w2 w2"), (91, None), (92, ""), (93, "..."), (94, "unknownterm"), (None, "w3 日本語"), (95, "one two"), (95, "one two"), (95, "w7")]
    return items_of(spark, [r + ("x", 5, 6, 7) for r in rows])


def test_search_against_brute_force(spark):
    docs = odd_documents(spark)
    items = odd_items(spark, docs)
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    asked = [(r.item_id, r.text) for r in items.collect()]
    for most in (10, 2):
        actual = Counter(tuple(r) for r in rs.ranked_search(docs, items, most).select("item_id", "rank", "doc_id", "score").collect())
        assert actual == slow_search(pairs, asked, most)


def test_no_documents_and_no_items(spark):
    docs, none = odd_documents(spark), items_of(spark, [])
    assert rs.ranked_search(docs, none).collect() == []
    assert rs.ranked_search(no_documents(spark), odd_items(spark, docs)).collect() == []


def test_copies_tie_by_id_over_many_tasks(spark):
    rows = [(i, "the same words in each") for i in range(400)] + [(1000 + i, f"other {i}") for i in range(300)]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = rs.ranked_search(docs, items_of(spark, [(1, "same each", "", 0, 0, 0)]))
    assert {r["rank"]: r.doc_id for r in found.collect()} == {i + 1: i for i in range(10)}


def test_queries_in_blocks(spark, monkeypatch):
    docs = odd_documents(spark)
    items = odd_items(spark, docs)
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    monkeypatch.setattr(rs, "QUERY_TEXTS", 9)
    found = rs.ranked_search(docs, items)
    assert Counter(tuple(r) for r in found.collect()) == slow_search(pairs, [(r.item_id, r.text) for r in items.collect()])


def test_blocks_are_read_one_by_one(spark):
    """Spark's reader holds a whole row group, so a file of many blocks must not be one."""
    docs = spark.range(0, 10_000, 1, 1).selectExpr("id AS doc_id", "concat('word ', id) AS text")
    files = [unquote(f.removeprefix("file://")) for f in rs.indexed(docs).inputFiles()]
    groups = [m.row_group(i).num_rows for m in map(pq.read_metadata, files) for i in range(m.num_row_groups)]
    assert groups == [1, 1, 1]


def test_large_rows_go_to_python_a_few_at_once(spark):
    limit = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    rows = spark.range(0, 40, 1, 1).selectExpr("repeat('x', 1000000) AS text")

    def counted(batches):
        for batch in batches:
            yield rs.pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    with bounded_batches(spark):
        found = [r.n for r in rows.mapInArrow(counted, "n long").collect()]
    assert sum(found) == 40 and max(found) <= 5
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == limit


def one_block(texts):
    block = rs._Block()
    for i, text in enumerate(texts):
        block.add(i, text)
    return block.batch()


@pytest.mark.parametrize("n", [1, 31, 33, 700])
def test_range_maxima(n):
    rng = np.random.default_rng(n)
    sizes = rng.integers(1, n + 1, 9)
    docs = np.concatenate([np.sort(rng.choice(n, k, replace=False)) for k in sizes])
    ends = np.cumsum(sizes)
    impacts = rng.integers(1, 50, len(docs))
    postings = rs.Postings(ends - sizes, ends, docs, impacts, n)
    for _ in range(300):
        term = rng.integers(9)
        a, b = np.sort(rng.integers(ends[term] - sizes[term], ends[term] + 1, 2))
        place, impact = postings.greatest(np.array([a]), np.array([b]))
        assert impact[0] == (impacts[a:b].max() if b > a else 0)
        assert b == a or (a <= place[0] < b and impacts[place[0]] == impact[0])


def test_intervals_that_cannot_win_are_not_scored():
    """A rare term decides: few of 4,000 documents are looked at."""
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["a", "b", "c", "d"], k=20)) + (" needle" if i % 250 == 7 else "") for i in range(4_000)]
    batch = one_block(texts)
    queries = rs.Queries.of(["needle a"])
    terms, places = rs._term_places(batch, 0, rs.pa.array(queries.terms, rs.pa.binary()))
    starts = rs._values(batch, "starts", 0).astype(np.int64)
    a, b = starts[places], starts[places + 1]
    own = np.concatenate([np.arange(x, y) for x, y in zip(a, b)])
    docs, counts = rs._values(batch, "docs", 0)[own].astype(np.int64), rs._values(batch, "counts", 0)[own].astype(np.int64)
    lengths = rs._values(batch, "lengths", 0)
    held = np.array([rs.term_weight(4_000, int(y - x)) for x, y in zip(a, b)])
    ends = np.cumsum(b - a)
    impacts = rs._impacts(np.repeat(held, b - a), counts, lengths[docs], 4_000, int(lengths.sum()))
    postings = rs.Postings(ends - (b - a), ends, docs, impacts, 4_000)
    best = rs.Best(10)
    scored = rs.search_block(postings, np.arange(2), np.ones(2, np.int64), list(range(4_000)), best)
    assert scored < 800
    expected = slow_search(list(enumerate(texts)), [(0, "needle a")])
    assert Counter((0, i, doc, -score) for i, (score, _, doc) in enumerate(best.held, 1)) == expected


def test_long_texts_are_read_whole():
    text = "x" * 5_000_000 + " middle " + "y " * 3_000_000 + "last"
    found = [term for terms in rs.terms_of(text) for term in terms]
    assert len(found) == 3_000_003 and found[1] == b"middle" and found[-1] == b"last"
    batch = one_block(["w " * 2_000_000 + "end", "w"])
    assert batch["lengths"][0].as_py() == [2_000_001, 1] and sorted(batch["counts"][0].as_py()) == [1, 1, 2_000_000]


def test_query_equals_its_statement(spark):
    name = "op13_ranked_search"
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        assert not differences(QUERIES[name](spark, sf), duck(sf), STATEMENTS[name])
