"""Languages and decision lists against slow versions written text by text."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.tables import odd_documents
from tradescribe.llm import decision_lists, subword_language
from tradescribe.llm.tables import stored

SF_DIR = "/root/testdata/sf0.001"
SPACE = b" \t\n\v\f\r"
LETTER = re.compile(r"[^\W\d_]")


def slow_buckets(text, buckets):
    """The bucket of each subword: letters A-Z small, white space one blank, digits one digit."""
    folded = bytearray()
    for byte in text.encode():
        folded.append(32 if byte in SPACE else 48 if 48 <= byte <= 57 else byte + 32 if 65 <= byte <= 90 else byte)
    found = []
    for n in subword_language.NGRAMS:
        for i in range(len(folded) - n + 1):
            key = int.from_bytes(folded[i : i + n], "big")
            bucket = ((key * 2654435761 + n * 40503) % 2**32) >> 7
            found.append((bucket ^ (bucket >> 11)) % buckets)
    return found


def slow_language(model, text):
    found = slow_buckets(text, len(model.scores))
    logits = []
    for k in range(len(model.languages)):
        mean = sum(float(model.scores[b, k]) for b in found) / max(1, len(found))
        logits.append((mean + float(model.bias[k])) / model.temperature)
    parts = [math.exp(x - max(logits)) for x in logits]
    best = max(range(len(parts)), key=parts.__getitem__)
    return model.languages[best], parts[best] / sum(parts)


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_languages_against_slow_version(spark, table):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = subword_language.language_model(docs.where(subword_language.in_training()))
    if table == "odd":
        docs = stored(odd_documents(spark), "odd")
    rows = subword_language.with_language(docs, model, "doc_id", "text").collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.text is None or not LETTER.search(r.text):
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        name, score = slow_language(model, r.text)
        assert r.lang_pred == name and r.score == pytest.approx(score, abs=1e-6)


def test_training_lowers_the_loss_of_separable_texts():
    """Texts of two alphabets are told apart, with the same model from the same rows."""
    texts = [("ab " if i % 2 else "xy ") * (3 + i % 7) for i in range(60)]
    rows = []
    for text in texts:
        counts = Counter(slow_buckets(text, 512))
        own = np.array(sorted(counts))
        rows.append((own, np.array([counts[b] for b in own], dtype=np.float32) / sum(counts.values())))
    labels = np.array([i % 2 for i in range(60)])
    model = subword_language.train(rows, labels, ("one", "two"), 512)
    again = subword_language.train(rows, labels, ("one", "two"), 512)
    assert (model.scores == again.scores).all() and model.temperature == again.temperature
    assert slow_language(model, "ab ab ab")[0] == "two" and slow_language(model, "xy xy xy xy")[0] == "one"
    assert slow_language(model, "ab ab ab")[1] > 0.9


def slow_features(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    data = text.encode()
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    repeated = {i + k for i, w in enumerate(windows) if w in twice for k in range(8)}
    letters = sum(65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in data)
    share = lambda a, b: a / max(b, 1)
    return len(words), len(repeated), {
        "words": float(len(words)),
        "word_length": share(sum(map(len, words)), len(words)),
        "symbols_per_word": share(sum(c in "#*$%&|<>" for c in text), len(words)),
        "duplicate_lines": share(len(lines) - len(set(lines)), len(lines)),
        "repeated_words": share(len(repeated), len(words)),
        "distinct_words": share(len(set(words)), len(words)),
        "capitals": share(sum(65 <= b <= 90 for b in data), letters),
        "digits": share(sum(48 <= b <= 57 for b in data), len(data)),
        "marks_per_word": share(sum(c in ".,;:!?\"'()-" for c in text), len(words)),
        "letters": share(letters, len(data)),
        "words_per_line": share(len(words), len(lines)),
    }


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_verdicts_against_slow_version(spark, table):
    """The list learned from the labels of a larger table, applied rule by rule in Python."""
    folder = "/root/testdata/sf0.01"
    learned = stored(decision_lists.text_statistics(spark.read.parquet(f"{folder}/documents.parquet")), "learned")
    rules = decision_lists.quality_rules(learned, spark.read.parquet(f"{folder}/labels.parquet"))
    assert rules
    docs = odd_documents(spark) if table == "odd" else spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs = stored(docs.select("doc_id", "text"), "judged")
    expected = Counter()
    for r in docs.collect():
        n_words, repeated, values = slow_features(r.text or "")
        failed = n_words < 20 or 100 * repeated > 30 * n_words
        rule = None
        for number, conditions in enumerate(rules, 1):
            if all((values[c.feature] >= c.threshold) == c.above for c in conditions):
                rule = number
                break
        expected[r.doc_id, failed, rule, not failed and rule is None] += 1
    rows = decision_lists.judged(decision_lists.text_statistics(docs), rules).collect()
    assert Counter((r.doc_id, r.base_failed, r.rule, r.kept) for r in rows) == expected
