"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradescribe.llm import (
    backoff_scores,
    blob_ledger,
    byte_bpe,
    conversation_repair,
    decision_lists,
    jaccard_join,
    jump_sharding,
    pattern_packing,
    personal_data,
    ranked_search,
    subword_language,
    toxicity_neighbours,
    vector_neighbours,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_vector_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_neighbours.near_vectors(_table(spark, sf_dir, "embeddings"))


def op2_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_scores.backoff_scores(_table(spark, sf_dir, "documents"))


def op3_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pattern_packing.packed(_table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_groups(_table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encoded_digests(_table(spark, sf_dir, "documents"))


def op6_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blob_ledger.secrets(_table(spark, sf_dir, "documents"))


def op7_decision_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decision_lists.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_toxicity_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_neighbours.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jump_sharding.sharded(_table(spark, sf_dir, "documents"))


def op10_subword_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword_language.languages(_table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repairs(_table(spark, sf_dir, "conversations"), damage=True)


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data(_table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_vector_neighbours,
        op2_backoff_scores,
        op3_pattern_packing,
        op4_jaccard_join,
        op5_byte_bpe,
        op6_blob_ledger,
        op7_decision_lists,
        op8_toxicity_neighbours,
        op9_jump_sharding,
        op10_subword_language,
        op11_conversation_repair,
        op12_personal_data,
        op13_ranked_search,
    )
}

_WORDS = r"[^\x20\x09-\x0D]+"

STATEMENTS: dict[str, str] = {
    "op2_backoff_scores": rf"""
WITH words AS (
    SELECT doc_id, w, i FROM (
        SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
        FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS ws FROM documents)
    )
),
pairs AS (
    SELECT doc_id, i, w, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS v FROM words
),
one AS (SELECT w, count(*) AS c FROM words GROUP BY w),
two AS (SELECT v, w, count(*) AS c FROM pairs WHERE v IS NOT NULL GROUP BY v, w),
scored AS (
    SELECT p.doc_id,
        CASE WHEN t.c >= {backoff_scores.LEAST_COUNT} THEN ln(t.c / before.c)
            ELSE ln(own.c / (SELECT count(*) FROM words))
                + CASE WHEN p.v IS NULL THEN 0 ELSE ln({backoff_scores.BACKOFF}) END
        END AS score,
        CASE WHEN p.v IS NOT NULL AND t.c < {backoff_scores.LEAST_COUNT} THEN 1 ELSE 0 END AS cut
    FROM pairs p
    JOIN one own ON own.w = p.w
    LEFT JOIN one before ON before.w = p.v
    LEFT JOIN two t ON t.v = p.v AND t.w = p.w
)
SELECT d.doc_id, count(s.score) AS n_words, CAST(coalesce(sum(s.cut), 0) AS BIGINT) AS n_backoff,
    round(avg(s.score), 6) AS mean_log_score
FROM documents d LEFT JOIN scored s ON s.doc_id = d.doc_id
GROUP BY d.doc_id
""",
    "op11_conversation_repair": rf"""
WITH RECURSIVE crc AS (
    SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) r(i)
),
fates AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(4294967295, list_reduce(
            [4294967295] || list_transform(
                string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                lambda x: CAST(ascii(x) AS BIGINT)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS fate
    FROM conversations, crc
),
hurt AS (
    SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
        CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM fates, range(2) r(copy) WHERE fate <> 0 AND (copy = 0 OR fate = 3)
),
sorted AS (
    SELECT *, row_number() OVER turns AS i, left(role, 1) AS initial, lag(left(role, 1)) OVER turns AS before
    FROM hurt WINDOW turns AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
        NOT regexp_matches(text, '{_WORDS}') AS blank,
        regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') AS cut
    FROM sorted
),
facts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
        count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
        count(*) FILTER (cut AND NOT again AND NOT blank) AS truncated,
        count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM placed GROUP BY conv_id
),
inserts(a, ins, b) AS (
    VALUES (0, '', 0), (0, 'I', 2), (0, 'II', 3), (1, '', 1), (1, 'I', 2), (1, 'II', 3), (2, '', 2), (2, 'I', 3), (3, '', 3), (3, 'I', 2)
),
steps(a, side, b) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
ways AS (
    SELECT conv_id, i, ins.a AS a, coalesce(s.b, ins.b) AS b,
        5 * length(ins) + CASE edit WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN cut AND edit <> 'D' THEN 5 ELSE 0 END AS cost,
        ins || edit AS letters
    FROM placed, inserts ins, (VALUES ('D'), ('K'), ('R')) e(edit)
    LEFT JOIN steps s ON s.a = ins.b AND edit <> 'D'
    WHERE edit = 'D' OR (NOT blank AND NOT again AND s.b IS NOT NULL
        AND ((edit = 'K' AND side = initial) OR (edit = 'R' AND side <> 's' AND side <> initial)))
),
best(conv_id, i, state, cost, audit) AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, CAST(0 AS BIGINT), '' FROM conversations
    UNION ALL
    SELECT conv_id, i, state, cost, audit FROM (
        SELECT b.conv_id, w.i, w.b AS state, b.cost + w.cost AS cost, b.audit || w.letters AS audit,
            row_number() OVER (PARTITION BY b.conv_id, w.b ORDER BY b.cost + w.cost, b.audit || w.letters) AS place
        FROM best b JOIN ways w ON w.conv_id IS NOT DISTINCT FROM b.conv_id AND w.i = b.i + 1 AND w.a = b.state
    ) WHERE place = 1
),
chosen AS (
    SELECT b.conv_id, b.cost + 5 * length(ins) AS cost, b.audit || ins AS audit,
        row_number() OVER (PARTITION BY b.conv_id ORDER BY b.cost + 5 * length(ins), b.audit || ins) AS place,
        length(b.audit || ins) - length(replace(b.audit || ins, 'D', '')) AS deleted
    FROM best b JOIN inserts ON inserts.a = b.state AND inserts.b IN (0, 3)
    LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM b.conv_id
    WHERE b.i = coalesce(f.n, 0)
),
letters AS (
    SELECT conv_id, letter, p, (length(audit) - deleted) % 2 AS odd,
        count(*) FILTER (letter <> 'I') OVER so_far AS i, count(*) FILTER (letter <> 'D') OVER so_far AS k
    FROM (SELECT *, unnest(string_split(audit, '')) AS letter, generate_subscripts(string_split(audit, ''), 1) AS p
          FROM chosen WHERE place = 1 AND audit <> '')
    WINDOW so_far AS (PARTITION BY conv_id ORDER BY p)
),
digests AS (
    SELECT l.conv_id, sha256(string_agg(
        CASE letter WHEN 'K' THEN r.role ELSE CASE WHEN (k - 1 + odd) % 2 = 0 THEN 'user' ELSE 'assistant' END END
            || ':' || CASE letter WHEN 'I' THEN '' ELSE r.text END, chr(10) ORDER BY l.p)) AS digest
    FROM letters l JOIN placed r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.i = greatest(l.i, 1)
    WHERE letter <> 'D' GROUP BY l.conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(c.cost AS BIGINT) AS cost, c.audit,
    coalesce(digest, sha256('')) AS repaired_sha256
FROM chosen c
LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN digests d ON d.conv_id IS NOT DISTINCT FROM c.conv_id
WHERE c.place = 1
""",
    "op13_ranked_search": r"""
WITH words AS (
    SELECT doc_id, part, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT doc_id, text, row_number() OVER () AS part FROM documents)
),
counts AS (SELECT doc_id, part, term, count(*) AS tf FROM words GROUP BY doc_id, part, term),
sizes AS (SELECT part, sum(tf) AS n FROM counts GROUP BY part),
totals AS (SELECT count(*) AS n, sum(n) AS l FROM sizes),
weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(t.n) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counts, totals t GROUP BY term
),
asked AS (
    SELECT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
),
scored AS (
    SELECT a.item_id, c.doc_id, c.part, sum(w.w * (
        (1000000000 * c.tf) // (1000 * c.tf + 8 * (100 - 75 + ((75 * s.n * t.n) // t.l))))) AS score
    FROM asked a JOIN counts c ON c.term = a.term JOIN weights w ON w.term = c.term
    JOIN sizes s ON s.part = c.part, totals t
    GROUP BY a.item_id, c.doc_id, c.part
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0)
WHERE place <= 10
""",
}
