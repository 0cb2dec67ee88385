"""Near copies among vectors by sorted projection passes.

Each pass hashes a vector to the signs of random projections, written one after
the other, and orders all vectors of a label by these bits.  Near vectors share
their first bits in some pass and then stand close together, so every vector is
compared with the next few in order, and the links found are united over all
passes.  How many leading bits single out a vector's window is measured for each
label.  Two vectors at an angle share so many bits with a known probability,
and from it follow the label's passes, for a stated share of missed pairs.  Where
these would be more than the blocks of the label, all blocks are compared in
pairs instead, which carries a vector less often and misses nothing.

The windows connect a group of near copies of any size, but do not see every
pair in it.  So all vectors of a connected group are compared at the end, as
pairs of blocks, which counts every link inside the group exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tradescribe.llm.components import UnionFind, components
from tradescribe.llm.tables import numbered, ship_package, shuffle_partitions, stored

THRESHOLD = 0.93
# Passes of every label, at least; one that needs more to miss so few pairs at the threshold has more.
PASSES = 24
MISSED = 0.001
MEASURED = 2  # passes that measure it
WINDOW = 12
BITS = 48
SEED = 20240501

# Vectors of a group that are compared in one task.
BLOCK = 2_048


def units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vectors scaled to length 1 in double precision, and which of them have a direction.

    One that is null, empty or zero, or holds a null or a number that is not
    finite, has none.  Vectors of different lengths are padded, never cut: zeros
    at the end change no cosine of two vectors of one length.
    """
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 0)), np.zeros(0, dtype=bool)
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    width = int(lengths.max())
    out = np.zeros((len(column), width))
    if width:
        values = column.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
        out[np.arange(width) < lengths[:, None]] = values
    peak = np.abs(out).max(axis=1, initial=0.0)
    usable = np.isfinite(peak) & (peak > 0)
    out[~usable] = 0
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    out[usable] /= peak[usable, None]
    out[usable] /= np.sqrt(np.einsum("ij,ij->i", out[usable], out[usable]))[:, None]
    return out, usable


def _keys(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """A row for each of its passes and vector, with the signs of the pass's projections as the sort key."""
    planes: dict[tuple[int, int], np.ndarray] = {}
    weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
    for batch in batches:
        vectors, usable = units(batch["embedding"])
        passes = np.where(usable, batch["passes"].to_numpy(), 0)
        lengths = batch["embedding"].value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        # The planes follow from a vector's own length, whatever else is in its batch.
        for width, k in [(w, k) for w in np.unique(lengths[passes > 0]).tolist() for k in range(int(passes[lengths == w].max()))]:
            if (width, k) not in planes:
                planes[width, k] = np.random.default_rng([SEED, width, k]).standard_normal((width, bits))
            rows = np.flatnonzero((passes > k) & (lengths == width))
            key = (vectors[rows, :width] @ planes[width, k] > 0) @ weights
            part = batch.select(["label", "vec", "embedding"]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rows), k, np.int32)), part["label"], pa.array(key), part["vec"], part["embedding"]],
                ["pass", "label", "key", "vec", "embedding"],
            )


def _depths(batches: Iterator[pa.RecordBatch], threshold: float, window: int, bits: int) -> Iterator[pa.RecordBatch]:
    """How many vectors of a label need so many leading bits until all that share them are in the window.

    A vector as far away as the window reaches that is itself a near copy does
    not count: the windows link it along the order.
    """
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        n = rows.num_rows
        depth = np.zeros(n, dtype=np.int64)
        if n > window:
            vectors, _ = units(rows["embedding"])
            where, key = _same_list(rows), rows["key"].to_numpy()
            apart = np.einsum("ij,ij->i", vectors[:-window], vectors[window:]) < threshold
            apart &= where[:-window] == where[window:]
            differ = np.frexp((key[:-window] ^ key[window:]).astype(float))[1]
            shared = np.where(apart, np.minimum(bits - differ + 1, bits), 0)
            depth[:-window] = shared
            depth[window:] = np.maximum(depth[window:], shared)
        pairs, counts = np.unique(np.stack([rows["label"].to_numpy(), depth]), axis=1, return_counts=True)
        yield pa.RecordBatch.from_pydict({"label": pa.array(pairs[0]), "depth": pa.array(pairs[1]), "n": pa.array(counts)})


def needed_passes(depth: np.ndarray, n: np.ndarray, threshold: float, missed: float) -> int:
    """Passes after which a pair at the threshold is expected in no window with a probability of at most `missed`.

    A very great number stands for any that is greater.
    """
    found = (1 - np.arccos(np.clip(threshold, -1, 1)) / np.pi) ** depth
    miss = lambda passes: float((n * (1 - found) ** passes).sum() / n.sum())
    low, high = 0, 1
    while miss(high) > missed and high < 1 << 30:
        low, high = high, 2 * high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if miss(middle) > missed else (low, middle)
    return high


def _passes(table: pa.Table, threshold: float, missed: float, measured: int, block: int) -> pa.Table:
    """The passes a label needs, and whether its blocks are fewer."""
    counts = table["n"].to_numpy()
    n = needed_passes(table["depth"].to_numpy(), counts, threshold, missed)
    blocks = -(-int(counts.sum()) // (measured * block))
    return pa.table({"of": table["label"][:1], "needed": pa.array([n], pa.int32()), "exact": pa.array([n > blocks])})


def _same_list(rows: pa.Table) -> np.ndarray:
    """A number for each pass and label in turn."""
    labels, passes = rows["label"].to_numpy(), rows["pass"].to_numpy()
    change = (labels[1:] != labels[:-1]) | (passes[1:] != passes[:-1])
    return np.concatenate([[0], np.cumsum(change)])


def window_links(rows: pa.Table, threshold: float, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of rows at most `window` apart, of one pass and label, that are near enough."""
    vectors, _ = units(rows["embedding"])
    where = _same_list(rows)
    lengths = rows["embedding"].combine_chunks().value_lengths().to_numpy()
    left, right = [], []
    for d in range(1, min(window, len(vectors) - 1) + 1):
        cosine = np.einsum("ij,ij->i", vectors[:-d], vectors[d:])
        near = np.flatnonzero((cosine >= threshold) & (where[:-d] == where[d:]) & (lengths[:-d] == lengths[d:]))
        left.append(near)
        right.append(near + d)
    none = np.zeros(0, np.int64)
    return np.concatenate(left or [none]), np.concatenate(right or [none])


def _windows(
    batches: Iterator[pa.RecordBatch], threshold: float, window: int, component: pa.DataType
) -> Iterator[pa.RecordBatch]:
    """Links of a sorted partition, and its first and last rows for the neighbours in other partitions."""
    task = TaskContext.get().partitionId()
    kinds = {**_BORDER, "embedding": pa.list_(component)}

    def links(rows: pa.Table, fresh: int) -> pa.RecordBatch:
        left, right = window_links(rows, threshold, window)
        new = right >= fresh
        ids = rows["vec"].to_numpy()
        forest = UnionFind(len(ids))
        pairs = [(ids[i], ids[j]) for i, j in zip(left[new], right[new]) if forest.join(int(i), int(j))]
        n = len(pairs)
        return pa.RecordBatch.from_pydict(
            {
                "a": pa.array([x for x, _ in pairs], pa.int64()),
                "b": pa.array([y for _, y in pairs], pa.int64()),
                **{name: pa.nulls(n, kind) for name, kind in kinds.items()},
            }
        )

    def border(rows: pa.Table, edge: int) -> pa.RecordBatch:
        n = rows.num_rows
        rows = rows.combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array([edge] * n, pa.int32())]
            + [rows[name].cast(kind) for name, kind in list(kinds.items())[1:]],
            ["a", "b", *kinds],
        )

    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if not rows.num_rows:
            continue
        fresh = 0
        if held is None:
            yield border(rows.slice(0, window), task - 1)
        else:
            fresh = held.num_rows
            rows = pa.concat_tables([held, rows])
        yield links(rows, fresh)
        held = rows.slice(max(0, rows.num_rows - window))
    if held is not None:
        yield border(held, task)


_BORDER = {
    "edge": pa.int32(),
    "pass": pa.int32(),
    "label": pa.int64(),
    "key": pa.int64(),
    "vec": pa.int64(),
}


def _across(table: pa.Table, threshold: float, window: int) -> pa.Table:
    table = table.sort_by([(name, "ascending") for name in ("pass", "label", "key", "vec")])
    left, right = window_links(table, threshold, window)
    ids = table["vec"].to_numpy()
    return pa.table({"a": pa.array(ids[left], pa.int64()), "b": pa.array(ids[right], pa.int64())})


def _compared(table: pa.Table, threshold: float, links: bool = False) -> pa.Table:
    """How many rows of the other block each vector links with; the rows of a vector weigh `copies`.

    With `links`, a spanning forest of the linked vectors comes as well, in rows (a, b).
    """
    vectors, _ = units(table["embedding"])
    own, i, j = table["own"].to_numpy(), table["i"][0].as_py(), table["j"][0].as_py()
    lengths = table["embedding"].combine_chunks().value_lengths().to_numpy()
    weight = table["copies"].to_numpy()
    a, b = np.flatnonzero(own == i), np.flatnonzero(own == j)
    near = (vectors[a] @ vectors[b].T >= threshold) & (lengths[a][:, None] == lengths[b][None, :])
    if i == j:
        np.fill_diagonal(near, False)
        ids, counts = a, near @ weight[b]
    else:
        ids, counts = np.concatenate([a, b]), np.concatenate([near @ weight[b], near.T @ weight[a]])
    found = pa.table({"vec": table["vec"].take(pa.array(ids)), "n": pa.array(counts, pa.int64())})
    if not links:
        return found
    names = table["vec"].to_numpy()
    left, right = np.nonzero(near)
    forest = UnionFind(len(names))
    pairs = [(names[x], names[y]) for x, y in zip(a[left].tolist(), b[right].tolist()) if forest.join(x, y)]
    ends = [pa.array([pair[i] for pair in pairs], pa.int64()) for i in (0, 1)]
    none = pa.nulls(len(pairs), pa.int64())
    return pa.concat_tables(
        [
            found.append_column("a", pa.nulls(len(found), pa.int64())).append_column("b", pa.nulls(len(found), pa.int64())),
            pa.table({"vec": none, "n": none, "a": ends[0], "b": ends[1]}),
        ]
    )


def _in_blocks(members: DataFrame, group: str, block: int) -> DataFrame:
    """A row for each pair of blocks (i, j) of a group that a vector takes part in; `own` is its block."""
    return (
        numbered(members, [group], ["vec"], "n", size="m")
        .select(group, "vec", F.expr(f"n div {block}").cast("int").alias("own"), F.expr(f"(m - 1) div {block}").cast("int").alias("last"))
        .select(group, "vec", "own", F.explode(F.sequence(F.lit(0), "last")).alias("other"))
        .select(group, "vec", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )


def near_vectors(
    embeddings: DataFrame,
    threshold: float = THRESHOLD,
    passes: int = PASSES,
    window: int = WINDOW,
    bits: int = BITS,
    block: int = BLOCK,
    missed: float = MISSED,
) -> DataFrame:
    """Each vector's links: vec_id, n_links, component_id, kept.

    Two vectors link when their labels are equal and not null and their cosine,
    in double precision, is at least `threshold`.  n_links counts the other rows
    linked directly, component_id is the smallest vec_id reachable, and kept
    marks the vector that bears it.  Passes are probabilistic: a link between
    groups that no pass brings within the window is missed, and none is invented.
    Every label has `passes` at least, and as many as a pair at the threshold
    needs to be missed with a probability of about `missed`; if that is more than
    the label has blocks, all its vectors are compared.  The threshold is above 0.

    A vector that is null, empty or zero or holds a null or a number that is not
    finite links with nothing, nor does one with a null label or of another
    length.  A row without vec_id links with nothing and has null component and
    kept.  Rows with equal label and vector are one class, so copies cost one
    vector; each gives a row.  Other columns are not read; an empty table gives no rows.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    spark = embeddings.sparkSession
    ship_package(spark)
    # Single precision is carried as it is: each comparison widens it without loss.
    narrow = embeddings.schema["embedding"].dataType.simpleString() == "array<float>"
    kind, component = ("array<float>", pa.float32()) if narrow else ("array<double>", pa.float64())
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast(kind))
    content = F.xxhash64("embedding"), F.hash("embedding")
    rows = rows.withColumns({"h1": content[0], "h2": content[1]})
    linkable = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    classes = stored(
        linkable.groupBy("label", "h1", "h2", "embedding")
        .agg(F.min("vec_id").alias("vec"), F.count(F.lit(1)).alias("copies")),
        "vectors-classes",
    )

    partitions = shuffle_partitions(spark)

    def ordered_by_keys(vectors: DataFrame) -> DataFrame:
        keyed = vectors.select("label", "vec", "embedding", "passes").mapInArrow(
            partial(_keys, bits=bits), f"pass int, label long, key long, vec long, embedding {kind}"
        )
        order = "pass", "label", "key", "vec"
        return keyed.repartitionByRange(partitions, *order).sortWithinPartitions(*order)

    measured = min(MEASURED, passes)
    needed = stored(
        ordered_by_keys(classes.withColumn("passes", F.lit(measured)))
        .mapInArrow(partial(_depths, threshold=threshold, window=window, bits=bits), "label long, depth long, n long")
        .groupBy("label", "depth")
        .agg(F.sum("n").alias("n"))
        .groupBy("label")
        .applyInArrow(
            lambda table: _passes(table, threshold, missed, measured, block), "of long, needed int, exact boolean"
        )
        .where(F.col("needed") > passes),
        "vectors-passes",
    )
    planned = classes.join(needed, F.col("label") == F.col("of"), "left")
    exact = F.coalesce("exact", F.lit(False))
    ordered = ordered_by_keys(planned.where(~exact).withColumn("passes", F.coalesce("needed", F.lit(passes))))
    # Vectors without a direction link with nothing in the comparison either.
    dense = stored(planned.where(exact).select("label", "vec"), "vectors-dense")
    compared = stored(
        _in_blocks(dense, "label", block)
        .join(classes.select("vec", "copies", "embedding"), "vec")
        .groupBy("label", "i", "j")
        .applyInArrow(lambda table: _compared(table, threshold, links=True), "vec long, n long, a long, b long"),
        "vectors-compared",
    )
    found = stored(
        ordered.mapInArrow(
            partial(_windows, threshold=threshold, window=window, component=component),
            f"a long, b long, edge int, pass int, label long, key long, vec long, embedding {kind}",
        ),
        "vectors-windows",
    )
    across = (
        found.where(F.col("edge").isNotNull())
        .groupBy("edge")
        .applyInArrow(lambda table: _across(table, threshold, window), "a long, b long")
    )
    groups = stored(
        components(
            found.select("a", "b").unionAll(compared.select("a", "b")).where(F.col("a").isNotNull()).unionAll(across)
        ),
        "vectors-groups",
    )

    members = stored(
        classes.join(groups, F.col("vec") == F.col("id"))
        .join(dense.select(F.col("vec").alias("_dense")), F.col("vec") == F.col("_dense"), "left_anti")
        .select("component_id", "vec"),
        "vectors-members",
    )
    counts = (
        _in_blocks(members, "component_id", block)
        .join(classes.select("vec", "copies", "embedding"), "vec")
        .groupBy("component_id", "i", "j")
        .applyInArrow(lambda table: _compared(table, threshold), "vec long, n long")
        .unionAll(compared.where(F.col("vec").isNotNull()).select("vec", "n"))
        .groupBy("vec")
        .agg(F.sum("n").alias("n"))
    )
    results = stored(
        classes.select("label", "h1", "h2", "embedding", "vec", "copies")
        .join(counts, "vec", "left")
        .join(groups, F.col("vec") == F.col("id"), "left")
        .select(
            "label",
            "h1",
            "h2",
            "embedding",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "vec").alias("component"),
        ),
        "vectors-results",
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    linked = (
        F.col("r.label").eqNullSafe(F.col("c.label"))
        & (F.col("r.h1") == F.col("c.h1"))
        & (F.col("r.h2") == F.col("c.h2"))
        & F.col("r.embedding").eqNullSafe(F.col("c.embedding"))
        & F.col("r.vec_id").isNotNull()
        & F.col("r.usable")
    )
    usable = F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    return (
        rows.withColumn("usable", usable)
        .alias("r")
        .join(results.alias("c"), linked, "left")
        .select(
            "r.vec_id",
            F.coalesce("c.n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("c.component", "r.vec_id").alias("component_id"),
            (F.col("r.vec_id") == F.coalesce("c.component", "r.vec_id")).alias("kept"),
        )
    )
