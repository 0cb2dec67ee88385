"""Exact Jaccard join of documents on word shingles, and the groups it links.

The product of the document-by-shingle incidence matrix with its transpose holds
the overlap of every two documents.  It is never computed whole:

1. Equal sets are one class, and only classes go on.
2. All shingles have one order, frequent ones last.  Two sets can be similar
   enough only if they share a shingle among the first |x| - ceil(t|x|) + 1 of
   each, so only these entries of the matrix are dealt out, by hash.  Any order
   is right; the frequent shingles are found by counts over all documents.
3. The classes that share such a shingle meet at the home of the smallest one.
   Parity bitmaps of a bit or two a shingle bound their overlap from above, and
   classes without a partner that can reach the size-derived bound are left out.
4. At each home, the incidence matrix of those that remain is multiplied block
   by block, which gives exact overlaps.  A home of many classes is dealt over
   tasks as pairs of blocks.

A home sends on a spanning forest of its links, so links grow with the documents
and not with the square of a group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tradescribe.llm.components import UnionFind, components
from tradescribe.llm.tables import numbered, ship_package, shuffle_partitions, stored
from tradescribe.llm.words import gram_hashes, text_slices, word_hashes, words_of

WORDS = 5
# Similarity as a fraction of whole numbers, so that every comparison is exact.
NUMERATOR, DENOMINATOR = 75, 100

# How many shingles can be known as frequent: 8 bytes each on every executor.
# The list only puts shingles in order and changes no result.
MOST_FREQUENT = 1 << 18
FREQUENT = 8

# Shingles counted together in a map task before it sends on those seen twice.
COUNTED = 6_000_000

# Classes of a home that are compared in one task.
BLOCK = 2_048

# Up to so many ids (8 bytes each), the documents that need their sets are found by a broadcast.
BROADCAST_IDS = 1_000_000


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a slice."""
    starts, ends, first = words_of(data, offsets)
    hashes = word_hashes(data, starts, ends, fold=True)
    grams = gram_hashes(hashes, words)
    sets = []
    for i in range(len(offsets) - 1):
        a, b = first[i], first[i + 1]
        if b - a >= words:
            sets.append(np.unique(grams[a : b - words + 1]))
        elif b > a:
            sets.append(gram_hashes(hashes[a:b], int(b - a)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def bits_for(size: int) -> int:
    """Length of a set's bitmap: a power of two, two to four bits a shingle."""
    return 1 << max(6, int(2 * size - 1).bit_length())


def parity_bitmap(shingles: np.ndarray) -> bytes:
    """Bit i is the parity of the number of shingles whose hash is i modulo the length."""
    bits = bits_for(len(shingles))
    counts = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(counts.astype(np.uint8) & 1, bitorder="little").tobytes()


def folded_bitmap(bitmap: np.ndarray, length: int) -> np.ndarray:
    """The bitmap of the same set at a shorter length, in bytes."""
    while len(bitmap) > length:
        half = len(bitmap) // 2
        bitmap = bitmap[:half] ^ bitmap[half:]
    return bitmap


def reaches(overlap: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether an overlap of two sets with that sum of sizes is similar enough."""
    return DENOMINATOR * overlap >= NUMERATOR * (sizes - overlap)


def prefix_length(sizes: np.ndarray) -> np.ndarray:
    return sizes - (NUMERATOR * sizes + DENOMINATOR - 1) // DENOMINATOR + 1


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    for batch in batches:
        ids = batch["doc_id"].to_pylist()
        for a, b, data, offsets in text_slices(batch["text"]):
            yield ids[a:b], shingle_sets(data, offsets, words)


_KEYED = "doc_id long, n_shingles long, key binary, bitmap binary"


def _keyed(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for ids, sets in _sets(batches, words):
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_shingles": pa.array(map(len, sets), pa.int64()),
                "key": pa.array(map(set_key, sets), pa.binary()),
                "bitmap": pa.array(map(parity_bitmap, sets), pa.binary()),
            }
        )


def _seen_twice(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    def counted(sets: list[np.ndarray]) -> pa.RecordBatch:
        shingles, counts = np.unique(np.concatenate(sets), return_counts=True)
        twice = counts > 1
        return pa.RecordBatch.from_pydict(
            {"shingle": pa.array(shingles[twice].view(np.int64)), "n": pa.array(counts[twice])}
        )

    held: list[np.ndarray] = []
    known: set[bytes] = set()
    n = 0
    for _, sets in _sets(batches, words):
        for shingles in sets:
            key = set_key(shingles)
            if len(shingles) and key not in known:
                known.add(key)
                held.append(shingles)
                n += len(shingles)
        if n >= COUNTED:
            yield counted(held)
            held, known, n = [], set(), 0
    if held:
        yield counted(held)


def frequent_shingles(texts: DataFrame, words: int, most: int = MOST_FREQUENT) -> np.ndarray:
    """The most frequent shingles, rarest first, as far as they matter for an order.

    Every map task counts all its shingles and sends on those it saw more than
    once.  A shingle in more documents than there are tasks is surely among them.
    """
    rows = (
        texts.mapInArrow(partial(_seen_twice, words=words), "shingle long, n long")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= FREQUENT)
        .orderBy(F.desc("n"), "shingle")
        .limit(most)
    )
    found = rows.toArrow()["shingle"].to_numpy()
    return found.view(np.uint64)[::-1].copy()


def _prefix(batches: Iterator[pa.RecordBatch], words: int, frequent, buckets: int) -> Iterator[pa.RecordBatch]:
    """Entries of the incidence matrix that can decide, packed by bucket for each slice of texts.

    A bucket's entry names the class by its place in `keys` and the shingle by 32 bits of its hash.
    """
    by_hash, rank = frequent.value
    for _, sets in _sets(batches, words):
        seen: set[bytes] = set()
        chosen, owners, keys = [], [], []
        for shingles in sets:
            key = set_key(shingles)
            if not len(shingles) or key in seen:
                continue
            seen.add(key)
            n = int(prefix_length(np.int64(len(shingles))))
            if len(by_hash):
                at = np.minimum(np.searchsorted(by_hash, shingles), len(by_hash) - 1)
                place = np.where(by_hash[at] == shingles, rank[at] + 1, 0)
                shingles = shingles[np.argsort(place, kind="stable")]
            chosen.append(shingles[:n])
            owners.append(np.full(n, len(keys), np.int64))
            keys.append(key)
        if not keys:
            continue
        shingles, owner = np.concatenate(chosen), np.concatenate(owners)
        bucket = (shingles % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((owner, bucket))
        shingles, owner, bucket = (shingles >> np.uint64(32)).astype(np.uint32)[order], owner[order], bucket[order]
        key_bytes = np.frombuffer(b"".join(keys), dtype=np.uint8).reshape(-1, 16)
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
        columns: dict[str, list] = {"bucket": [], "keys": [], "counts": [], "shingles": []}
        for a, b in zip(cuts[:-1], cuts[1:]):
            own, counts = np.unique(owner[a:b], return_counts=True)
            columns["bucket"].append(int(bucket[a]))
            columns["keys"].append(key_bytes[own].tobytes())
            columns["counts"].append(counts.astype(np.uint32).tobytes())
            columns["shingles"].append(shingles[a:b].tobytes())
        yield pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array(columns["bucket"], pa.int32()),
                **{name: pa.array(columns[name], pa.binary()) for name in ("keys", "counts", "shingles")},
            }
        )


_KEY = np.dtype([("first", np.uint64), ("second", np.uint64)])


def _homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(home, key) for the classes of each shingle of one task, the home, which is the smallest of them, included."""
    buckets, keys, shingles, owners = [], [], [], []
    at = 0
    for batch in batches:
        for row in batch.to_pylist():
            own = np.frombuffer(row["keys"], dtype=_KEY)
            counts = np.frombuffer(row["counts"], dtype=np.uint32)
            part = np.frombuffer(row["shingles"], dtype=np.uint32)
            keys.append(own)
            owners.append(np.repeat(np.arange(at, at + len(own)), counts))
            shingles.append(part.astype(np.uint64) | np.uint64(row["bucket"] << 32))
            at += len(own)
    if not keys:
        return
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    owner, shingle = place[np.concatenate(owners)], np.concatenate(shingles)
    order = np.lexsort((owner, shingle))
    owner, shingle = owner[order], shingle[order]
    first = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]])
    home = np.repeat(owner[first], np.diff(np.r_[first, len(shingle)]))
    met = home != owner
    pairs = home[met] * len(distinct) + owner[met]
    pairs = np.unique(np.concatenate([pairs, np.unique(home[met]) * (len(distinct) + 1)]))
    raw = [x.tobytes() for x in distinct]
    for a in range(0, len(pairs), 50_000):
        home, owner = np.divmod(pairs[a : a + 50_000], len(distinct))
        yield pa.RecordBatch.from_pydict(
            {
                "home": pa.array([raw[i] for i in home], pa.binary()),
                "key": pa.array([raw[i] for i in owner], pa.binary()),
            }
        )


def _sorted_by_size(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    table = table.sort_by([("n_shingles", "ascending"), ("key", "ascending")])
    return table, table["n_shingles"].to_numpy()


def _hopeful(table: pa.Table) -> pa.Table:
    """The classes of a block pair that have a partner which, by their bitmaps, may be similar enough."""
    table, sizes = _sorted_by_size(table)
    keep = np.zeros(len(sizes), dtype=bool)
    maps = [np.frombuffer(x, dtype=np.uint8) for x in table["bitmap"].to_pylist()]
    lengths = np.array([len(x) for x in maps])
    shortest: dict[int, np.ndarray] = {}
    for i in range(len(sizes)):
        # Partners of at least this size, up to the largest that can be similar enough.
        end = int(np.searchsorted(sizes, DENOMINATOR * sizes[i] // NUMERATOR, side="right"))
        if end <= i + 1:
            continue
        length = int(lengths[i])
        if length not in shortest:
            from_here = int(np.searchsorted(lengths, length))
            shortest = {length: np.stack([folded_bitmap(x, length) for x in maps[from_here:]]).view(np.uint64)}
            base = from_here
        rest = shortest[length]
        apart = np.bitwise_count(rest[i + 1 - base : end - base] ^ rest[i - base]).sum(axis=1, dtype=np.int64)
        total = sizes[i + 1 : end] + sizes[i]
        near = np.flatnonzero(reaches((total - apart) // 2, total))
        if len(near):
            keep[i] = True
            keep[i + 1 + near] = True
    return table.filter(pa.array(keep)).select(["home", "key"])


def overlaps(sets: list[np.ndarray], dense_from: int = 24, columns: int = 1024) -> np.ndarray:
    """The overlap of every two sets: the incidence matrix times its transpose, by blocks of columns.

    A column that few sets have adds its few pairs one by one; the others are multiplied as dense blocks.
    """
    n = len(sets)
    total = np.zeros((n, n), dtype=np.int64)
    if not n:
        return total
    shingles = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(x) for x in sets])
    order = np.argsort(shingles, kind="stable")
    shingles, owner = shingles[order], owner[order]
    first = np.flatnonzero(np.r_[True, shingles[1:] != shingles[:-1]])
    count = np.diff(np.r_[first, len(shingles)])
    for d in np.unique(count[(count > 1) & (count < dense_from)]):
        rows = owner[first[count == d][:, None] + np.arange(d)]
        for i in range(d):
            for j in range(i + 1, d):
                np.add.at(total, (rows[:, i], rows[:, j]), 1)
    many = np.flatnonzero(count >= dense_from)
    for a in range(0, len(many), columns):
        part = many[a : a + columns]
        block = np.zeros((n, len(part)), dtype=np.float32)
        which = np.repeat(np.arange(len(part)), count[part])
        inside = np.arange(len(which)) - np.repeat(np.cumsum(count[part]) - count[part], count[part])
        block[owner[first[part][which] + inside], which] = 1
        total += np.triu(block @ block.T, 1).astype(np.int64)
    return total + total.T


def _linked(table: pa.Table) -> pa.Table:
    """A spanning forest of the links among the classes of a block pair."""
    table, sizes = _sorted_by_size(table)
    sets = [np.frombuffer(x, dtype=np.uint64) for x in table["shingles"].to_pylist()]
    shared = overlaps(sets)
    near = np.triu(reaches(shared, sizes[:, None] + sizes[None, :]) & (shared > 0), 1)
    ids = table["doc_id"].to_numpy()
    forest = UnionFind(len(sizes))
    links = [(ids[i], ids[j]) for i, j in zip(*np.nonzero(near)) if forest.join(int(i), int(j))]
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def _in_blocks(members: DataFrame, block: int) -> DataFrame:
    """Distinct members(home, key) with the pairs of blocks (i, j) in which each is compared; a small home is one block."""
    ranked = numbered(members, ["home"], ["key"], "n", size="m", unique=True)
    own = F.expr(f"n div {block}").cast("int")
    blocks = F.expr(f"(m - 1) div {block}").cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks")))
    return (
        ranked.select("home", "key", own.alias("own"), blocks.alias("blocks"))
        .select("home", "key", "own", other.alias("other"))
        .select("home", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )


def _set_rows(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for _, sets in _sets(batches, words):
        yield pa.RecordBatch.from_pydict(
            {
                "key": pa.array(map(set_key, sets), pa.binary()),
                "shingles": pa.array([x.tobytes() for x in sets], pa.binary()),
            }
        )


def jaccard_groups(documents: DataFrame, words: int = WORDS, block: int = BLOCK) -> DataFrame:
    """Each document's group: doc_id, n_shingles, class_id, component_id.

    Words are runs of bytes other than white space, with A to Z in lower case; a
    document's set holds its distinct shingles of `words` words, or all words as
    one shingle if there are fewer.  Documents link when their sets' Jaccard
    similarity is at least 0.75.  component_id is the smallest doc_id reachable by
    links, class_id the smallest doc_id with an equal set.

    A document without words, or with a null text, has no shingles and links with
    nothing.  A row without doc_id links with nothing and its class and component
    are null.  Every row of the input gives a row, repeated ones too; doc_id should
    identify a document: different texts under one doc_id may have their groups
    united.  Other columns are not read; an empty table gives no rows.
    """
    spark = documents.sparkSession
    ship_package(spark)
    texts = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = stored(texts.mapInArrow(partial(_keyed, words=words), _KEYED), "jaccard-keyed")
    linkable = keyed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = stored(
        linkable.groupBy("key").agg(
            F.min("doc_id").alias("class_id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bitmap").alias("bitmap"),
        ),
        "jaccard-classes",
    )

    named = texts.where(F.col("doc_id").isNotNull())
    frequent = frequent_shingles(named, words)
    order = np.argsort(frequent, kind="stable")
    ranked = spark.sparkContext.broadcast((frequent[order], order.astype(np.int64)))
    buckets = shuffle_partitions(spark)
    entries = named.mapInArrow(
        partial(_prefix, words=words, frequent=ranked, buckets=buckets),
        "bucket int, keys binary, counts binary, shingles binary",
    )
    members = stored(
        entries.repartition(buckets, "bucket").mapInArrow(_homes, "home binary, key binary").distinct(),
        "jaccard-members",
    )

    hopeful = stored(
        _in_blocks(members, block)
        .join(classes.select("key", "n_shingles", "bitmap"), "key")
        .groupBy("home", "i", "j")
        .applyInArrow(_hopeful, "home binary, key binary")
        .distinct(),
        "jaccard-hopeful",
    )

    wanted = hopeful.select("key").distinct().join(classes, "key").select("class_id")
    wanted = stored(wanted, "jaccard-wanted")
    few = wanted.count() <= BROADCAST_IDS
    chosen = named.join(
        F.broadcast(wanted) if few else wanted, F.col("doc_id") == F.col("class_id"), "left_semi"
    )
    sets = stored(
        chosen.mapInArrow(partial(_set_rows, words=words), "key binary, shingles binary")
        .dropDuplicates(["key"])
        .join(classes.select("key", F.col("class_id").alias("doc_id"), "n_shingles"), "key"),
        "jaccard-sets",
    )
    links = (
        _in_blocks(hopeful, block)
        .join(sets, "key")
        .groupBy("home", "i", "j")
        .applyInArrow(_linked, "a long, b long")
    )
    groups = components(links)
    class_groups = stored(
        classes.join(groups, F.col("class_id") == F.col("id"), "left").select(
            "key", "class_id", F.coalesce("component_id", "class_id").alias("component_id")
        ),
        "jaccard-groups",
    )
    can_link = (F.col("d.n_shingles") > 0) & F.col("d.doc_id").isNotNull()
    return (
        keyed.alias("d")
        .join(class_groups.alias("g"), (F.col("d.key") == F.col("g.key")) & can_link, "left")
        .select(
            "d.doc_id",
            "d.n_shingles",
            F.coalesce("g.class_id", "d.doc_id").alias("class_id"),
            F.coalesce("g.component_id", "d.doc_id").alias("component_id"),
        )
    )


def one_of_each_group(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """The documents with the smallest doc_id of their group; all columns stay.

    A document that links with nothing stays, also one without doc_id or words.
    Rows that repeat a doc_id are one document, of which one row stays.
    """
    groups = stored(jaccard_groups(documents, words).select("doc_id", "component_id"), "jaccard-kept")
    gone = stored(
        groups.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_gone")).distinct(), "jaccard-gone"
    )
    rows = documents.alias("d")
    id_ = F.col("d.doc_id").cast("long")
    few = gone.count() <= BROADCAST_IDS
    kept = rows.join(F.broadcast(gone) if few else gone, id_ == F.col("_gone"), "left_anti")
    repeated = stored(
        groups.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("_again"))
        .count()
        .where(F.col("count") > 1)
        .select("_again"),
        "jaccard-repeated",
    )
    if repeated.isEmpty():
        return kept
    kept = kept.alias("d")
    again = kept.join(repeated, id_ == F.col("_again"), "left_semi")
    return kept.join(repeated, id_ == F.col("_again"), "left_anti").unionAll(again.dropDuplicates(["doc_id"]))
