"""Cases that operators once got wrong: equal hashes, odd vectors, dense labels, prose in masks, samples of copies."""

from __future__ import annotations

import time

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.tables import labels
from tests.llm.test_operators import slow_counts, slow_groups
from tradescribe.llm import (
    backoff_scores,
    blob_ledger,
    decision_lists,
    jaccard_join,
    subword_language,
    vector_neighbours,
)
from tradescribe.llm.tables import stored

# Two words of 1,024 letters that every polynomial modulo 2^64 takes for one.
ONE = "".join("ab"[bin(i).count("1") % 2] for i in range(1_024))
OTHER = ONE.translate(str.maketrans("ab", "ba"))


def test_words_with_equal_polynomials(spark):
    rest = " ".join(f"w{i}" for i in range(30))
    texts = {1: ONE, 2: OTHER, 3: f"{ONE} {rest}", 4: f"{OTHER} {rest}", 5: f"{ONE}\n{OTHER}\n{ONE}", 6: f"{rest} {ONE} {rest} {OTHER}"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    groups = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_groups(docs).collect()}
    assert groups == slow_groups(list(texts.items()))
    counts = {r.doc_id: tuple(r[name] for name in decision_lists.BASE) for r in decision_lists.text_statistics(docs).collect()}
    assert counts == {d: slow_counts(t) for d, t in texts.items()}
    scores = {r.doc_id: r.mean_log_score for r in backoff_scores.backoff_scores(docs).collect()}
    total = sum(len(t.split()) for t in texts.values())
    assert scores[1] == pytest.approx(np.log(5 / total), abs=1e-5) and scores[2] == pytest.approx(np.log(4 / total), abs=1e-5)


# Vectors


def slow_links(rows, threshold=0.93):
    """n_links by vec_id, for (vec_id, vector, label)."""
    out = dict.fromkeys((v for v, _, _ in rows), 0)
    keys = {(label, len(vector)) for _, vector, label in rows}
    for key in keys:
        own = [(v, x) for v, x, label in rows if (label, len(x)) == key]
        m = np.array([x for _, x in own], dtype=float)
        m /= np.linalg.norm(m, axis=1)[:, None]
        near = m @ m.T >= threshold
        for (v, _), n in zip(own, near.sum(axis=1) - 1):
            out[v] += int(n)
    return out


def pairs(rng, n, width, label, first, centre=0.0, noise=0.36):
    """n pairs of cosine about 0.93 to 0.95, apart from each other but for a common direction."""
    rows = []
    middle = rng.standard_normal(width) * centre
    for i in range(n):
        x = rng.standard_normal(width) + middle
        y = rng.standard_normal(width)
        y = y / np.linalg.norm(y) * np.linalg.norm(x) * noise
        rows += [(first + 2 * i, x.tolist(), label), (first + 2 * i + 1, (x + y).tolist(), label)]
    return rows


def recall(spark, rows, partitions):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(partitions)
    found = {r.vec_id: r.n_links for r in vector_neighbours.near_vectors(df).collect()}
    expected = slow_links(rows)
    assert all(found[v] <= n for v, n in expected.items())
    linked = [v for v, n in expected.items() if n]
    return sum(found[v] == expected[v] for v in linked) / len(linked), len(linked)


def test_a_vector_of_another_length_changes_no_other_vectors(spark):
    """In several batches, of which one holds it."""
    rng = np.random.default_rng(1)
    rows = pairs(rng, 6_000, 64, 1, 0)
    found, linked = recall(spark, rows + [(99_999, rng.standard_normal(65).tolist(), 1)] + pairs(rng, 50, 33, 1, 100_000), 5)
    assert linked > 8_000 and found > 0.99


def test_a_dense_label_is_compared_in_blocks(spark):
    """Around a common direction, hundreds of passes would be needed; all links are found."""
    rng = np.random.default_rng(2)
    rows = pairs(rng, 2_500, 64, 1, 0, centre=1.7, noise=0.39) + pairs(rng, 300, 64, 2, 50_000)
    found, linked = recall(spark, rows, 3)
    assert linked > 2_000 and found == 1.0


def test_links_of_a_dense_label_are_those_of_its_forest(spark):
    """Chains of near vectors in more than one block."""
    angles = np.arange(600) * 0.05
    rows = [(i, [float(np.cos(a)), float(np.sin(a)), 3.0], 1) for i, a in enumerate(angles)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = vector_neighbours.near_vectors(df, 0.995, block=64).collect()
    expected = slow_links(rows, 0.995)
    assert {r.vec_id: r.n_links for r in found} == expected and {r.component_id for r in found} == {0}


def test_thresholds_without_a_meaning(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<double>, label int")
    for threshold in (-1.0, 0.0, 1.5):
        with pytest.raises(ValueError):
            vector_neighbours.near_vectors(df, threshold)


# Secrets

KEY = "MIIEpAIBAAKCAQEA7bq0\nabcdefghijklmnopqrstuvwxyz0123456789+/ab\nQw=="


def test_masks_never_reach_prose(spark):
    prose = "is how a key begins, and then comes prose. " * 120
    texts = {
        1: f"intro -----BEGIN RSA PRIVATE KEY----- {prose}",
        2: f"a\n-----BEGIN PRIVATE KEY-----\n{KEY}\n-----END PRIVATE KEY-----\nb",
        3: f"-----BEGIN EC PRIVATE KEY-----\n{KEY}\n\n{prose}",
        4: f"-----BEGIN PRIVATE KEY-----\nextraordinarilylongword and {prose}",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    clean = {r.doc_id: r.text for r in blob_ledger.masked(docs).collect()}
    assert clean[1] == f"intro [secret] {prose}"
    assert clean[2] == "a\n[secret]\nb"
    assert "MIIE" not in clean[3] and "abcdefghijkl" not in clean[3] and clean[3].endswith(prose)
    assert clean[4].endswith(f"extraordinarilylongword and {prose}")


@pytest.mark.parametrize(
    "text", ["a" * 400_000 + "://", "eyJ" * 130_000, "eyJabcdefgh." * 30_000, "-----BEGIN " * 40_000, "a+" * 200_000 + "://x:yyyyyyy@", "bearer " * 60_000, "-----BEGIN PRIVATE KEY-----" * 15_000]
)
def test_rules_take_linear_time(text):
    start = time.perf_counter()
    blob_ledger.spans_of(text)
    assert time.perf_counter() - start < 1


def test_another_rule_is_another_version():
    changed = (*blob_ledger.RULES[:-1], blob_ledger.Rule("userinfo", "x", ("://",)))
    assert blob_ledger.hashlib.sha256(repr(changed).encode()).hexdigest()[:16] != blob_ledger.RULES_VERSION


# Samples


def test_copies_of_a_row_do_not_decide_the_language_model(spark):
    docs = stored(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang"), "odd-languages")
    row = docs.where(subword_language.in_training() & F.col("lang").isNotNull() & (F.length("text") > 200)).orderBy("doc_id").limit(1)
    copies = docs.unionAll(row.crossJoin(spark.range(8_000)).select("doc_id", "text", "lang"))

    def accuracy(rows):
        test = rows.join(docs.select(F.col("doc_id").alias("d"), "lang"), F.col("doc_id") == F.col("d")).where("held_out and lang is not null")
        return test.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]

    plain, crowded = accuracy(subword_language.languages(docs)), accuracy(subword_language.languages(copies))
    assert plain > 0.97 and abs(plain - crowded) < 0.02


def test_a_rare_language_is_learned(spark):
    english = [(i, f"the way of the house and the river {i} with some more words", "en") for i in range(6_000)]
    other = [(10_000 + i, f"żółć gęślą jaźń wśród łąk i pól {i} także później", "pl") for i in range(40)]
    docs = spark.createDataFrame(english + other, "doc_id long, text string, lang string")
    model = subword_language.language_model(docs, 500)
    assert model.languages == ("en", "pl")
    new = spark.createDataFrame([(1, "jaźń wśród pól żółć"), (2, "the house of the river")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in subword_language.with_language(new, model, "doc_id").collect()} == {1: "pl", 2: "en"}


def test_documents_stay_where_no_language_is_known(spark):
    docs = spark.createDataFrame([(i, f"some text {i}", None) for i in range(20)], "doc_id long, text string, lang string")
    assert corpus_pipeline.in_known_language(spark, docs, "unused").count() == 20


def test_a_repeated_document_is_one_row_of_the_quality_sample(spark):
    good = [(i, "This is a plain sentence of some words and no odd signs. " * (2 + i % 5)) for i in range(300)]
    bad = [(1_000 + i, "## $$ %% " * (20 + i % 7)) for i in range(100)]
    copies = [(5, "This is a plain sentence of some words and no odd signs. " * 3)] * 3_000
    known = labels(spark, [(d, 1, None, None) for d, _ in good] + [(d, 0, None, None) for d, _ in bad])

    def rules(rows):
        statistics = stored(decision_lists.text_statistics(spark.createDataFrame(rows, "doc_id long, text string")), "odd-quality")
        return decision_lists.quality_rules(statistics, known, 400)

    assert rules(good + bad) and rules(good + bad + copies) and len(rules(good + bad + copies)) == len(rules(good + bad))
