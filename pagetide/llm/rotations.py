"""Near-duplicate vectors by cross-polytope hashing.

A hash turns a vector by fast pseudo-random rotations (three rounds of random signs and a
Hadamard transform) and takes the axis, with its sign, that the result is nearest to. A bucket
is ``hashes`` of them together, and there are ``tables`` independent kinds of buckets. A vector
has one bucket of its own per table and ``probes`` more: those it would have been in with the
smallest change. Two vectors meet where one's own bucket is among the other's buckets; every
pair that meets is verified by its cosine in double precision, so no link is false.

With 3 hashes, 8 tables and 5 probes in 64 dimensions, of pairs with a cosine of just 0.95 about
one in ten thousand never meets; nearer pairs are missed less.

Equal vectors are one class and take part once, with their number. Buckets are listed by
narrow rows first, and only those in which a pair can meet get vectors. A bucket with many members
is cut into blocks and compared pair of blocks by pair of blocks. A pair that meets in several
buckets counts in the first. Pairs are never listed: a pair of blocks gives each member's number of links
and its place in a spanning forest.

Defined cases: a vector that is null, empty, zero, or holds a null or non-finite component links
with nothing: it has no links, is its own component and is kept. Vectors of different length do
not link. Of repeated rows each counts; a null id is never the smallest of a component unless
all are null, and then the component is null. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pagetide.llm.common import join_counted
from pagetide.llm.components import components
from pagetide.llm.negatives import finite, vectors_of
from pagetide.sources.tables import stored

#: Next-best axes of one hash that probes may take.
CHOICES = 4
#: Bits of a bucket's number below those of its table.
TABLE_SHIFT = 56


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The orthonormal Walsh-Hadamard transform of every row; a power of two wide."""
    n, dim = rows.shape
    step = 1
    while step < dim:
        halves = rows.reshape(n, -1, 2, step)
        rows = np.stack([halves[:, :, 0] + halves[:, :, 1], halves[:, :, 0] - halves[:, :, 1]], axis=2).reshape(n, dim)
        step *= 2
    return rows / np.sqrt(dim)


def rotated(rows: np.ndarray, table: int, k: int) -> np.ndarray:
    random = np.random.default_rng([table, k])
    for _ in range(3):
        rows = hadamard(rows * random.choice([-1.0, 1.0], rows.shape[1]))
    return rows


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; first scaled, so that squares neither overflow nor vanish."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def buckets_of(rows: np.ndarray, tables: int, hashes: int, probes: int) -> np.ndarray:
    """rows x tables x (1 + probes): a row's own bucket and those probed, nearest first; -1 for none."""
    n, dim = rows.shape
    wide = np.zeros((n, max(2, 1 << (dim - 1).bit_length())))
    wide[:, :dim] = unit(rows)
    axes = wide.shape[1]
    choices = min(CHOICES, axes)
    if (2 * axes) ** hashes >= 2**TABLE_SHIFT:
        raise ValueError(f"{hashes} hashes of {dim} dimensions do not fit a bucket's number")
    picks = np.array(list(product(range(choices), repeat=hashes)))
    out = np.full((n, tables, 1 + probes), -1, np.int64)
    for table in range(tables):
        cost, code = np.zeros((n, len(picks))), np.full((n, len(picks)), table << TABLE_SHIFT)
        for k in range(hashes):
            turned = rotated(wide, table, k)
            size = np.abs(turned)
            axis = np.argsort(-size, axis=1, kind="stable")[:, :choices]
            size = np.take_along_axis(size, axis, 1)
            signed = 2 * axis + (np.take_along_axis(turned, axis, 1) < 0)
            cost += (size[:, :1] - size)[:, picks[:, k]] ** 2
            code += signed[:, picks[:, k]] * (2 * axes) ** k
        nearest = np.argsort(cost, axis=1, kind="stable")[:, : 1 + probes]
        out[:, table, : nearest.shape[1]] = np.take_along_axis(code, nearest, 1)
    return out


def marked(classes: DataFrame, tables: int, hashes: int, probes: int, slice_rows: int = 4096) -> DataFrame:
    """class, n, dim, vector, buckets of ``classes(class, n, vector)``."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, slice_rows):
                batch = whole.slice(at, slice_rows)
                flat, sizes = vectors_of(batch.column("vector"))
                starts = np.cumsum(sizes) - sizes
                for dim in np.unique(sizes):
                    own = np.flatnonzero(sizes == dim)
                    rows = flat[starts[own][:, None] + np.arange(dim)]
                    found = buckets_of(rows, tables, hashes, probes).reshape(len(own), -1)
                    offsets = pa.array(np.arange(len(own) + 1, dtype=np.int32) * found.shape[1])
                    kept = batch.take(pa.array(own))
                    yield pa.RecordBatch.from_arrays(
                        [
                            kept.column("class"), kept.column("n"), pa.array(np.full(len(own), dim, np.int32)),
                            kept.column("vector"), pa.ListArray.from_arrays(offsets, pa.array(found.ravel())),
                        ],
                        names=["class", "n", "dim", "vector", "buckets"],
                    )

    kind = classes.schema["vector"].dataType.simpleString()
    return classes.mapInArrow(mark, f"class bigint, n bigint, dim int, vector {kind}, buckets array<bigint>")


def met_at(buckets: np.ndarray, left: np.ndarray, right: np.ndarray, table: int) -> np.ndarray:
    """The first bucket of a table in which each pair meets, -1 for none."""
    none = np.iinfo(np.int64).max
    first = np.full(len(left), none)
    for a, b in ((left, right), (right, left)):
        own = buckets[a, table, 0]
        first = np.where((own[:, None] == buckets[b, table]).any(axis=1), np.minimum(first, own), first)
    return np.where(first == none, -1, first)


def forest(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """The smallest member, by place, that each of ``n`` is linked to."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def compared(bucket: int, i: int, j: int, group: dict[str, np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per member of two blocks of a bucket: number of linked rows first met here, and a linked member's place."""
    block, vectors, buckets, n = group["block"], group["vector"], group["buckets"], group["n"]
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    if not len(left) or not len(right):
        return np.zeros(len(n), np.int64), np.arange(len(n)), np.zeros(0, np.int64)
    a, b = np.nonzero(vectors[left] @ vectors[right].T >= least)
    a, b = left[a], right[b]
    table = bucket >> TABLE_SHIFT
    keep = (a < b) if i == j else np.ones(len(a), bool)
    a, b = a[keep], b[keep]
    for earlier in range(table):
        fresh = met_at(buckets, a, b, earlier) < 0
        a, b = a[fresh], b[fresh]
    here = met_at(buckets, a, b, table) == bucket
    a, b = a[here], b[here]
    links = np.zeros(len(n), np.int64)
    np.add.at(links, a, n[b])
    np.add.at(links, b, n[a])
    return links, forest(a, b, len(n)), np.union1d(a, b)


def linked(tiles: DataFrame, least: float, tables: int) -> DataFrame:
    """class, links, root: what every pair of blocks found; several rows per class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def answer(table: pa.Table) -> Iterator[pa.RecordBatch]:
            table = table.combine_chunks()
            keys = [np.asarray(table[c], np.int64) for c in ("dim", "bucket", "i", "j")]
            edge = np.flatnonzero(np.any([np.diff(k, prepend=k[0] - 1) != 0 for k in keys], axis=0))
            classes, n = (np.asarray(table[c], np.int64) for c in ("class", "n"))
            block = np.asarray(table["block"], np.int64)
            flat, sizes = vectors_of(table["vector"])
            start = np.append(np.cumsum(sizes) - sizes, sizes.sum())
            marks = np.asarray(table["buckets"].combine_chunks().flatten(), np.int64).reshape(table.num_rows, tables, -1)
            found: list[tuple] = []
            for at, end in zip(edge, np.append(edge[1:], table.num_rows)):
                group = {
                    "block": block[at:end], "n": n[at:end], "buckets": marks[at:end],
                    "vector": unit(flat[start[at] : start[end]].reshape(end - at, -1)),
                }
                links, root, own = compared(int(keys[1][at]), int(keys[2][at]), int(keys[3][at]), group, least)
                if len(own):
                    found.append((classes[at:end][own], links[own], classes[at:end][root[own]]))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in zip(*found)], names=["class", "links", "root"]
                )

        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            table = pa.Table.from_batches(waiting)
            # The last group may go on in the next batch.
            last = [table[c][-1] for c in ("dim", "bucket", "i", "j")]
            whole = table.num_rows
            while whole and [table[c][whole - 1] for c in ("dim", "bucket", "i", "j")] == last:
                whole -= 1
            if whole:
                yield from answer(table.slice(0, whole))
            waiting = table.slice(whole).combine_chunks().to_batches()
        if waiting:
            yield from answer(pa.Table.from_batches(waiting))

    return tiles.mapInArrow(run, "class bigint, links bigint, root bigint")


def near_vectors(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    least: float = 0.95,
    tables: int = 8,
    hashes: int = 3,
    probes: int = 5,
    block: int = 512,
) -> DataFrame:
    """id, n_links, component_id, kept of every row."""
    rows = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    fine = F.coalesce(finite(F.col("vector")) & F.exists("vector", lambda x: x != 0), F.lit(False))
    # Equal vectors, and so -0.0 and 0.0, are one class.
    classes = rows.filter(fine).groupBy("vector").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()))
    marks = stored(marked(classes.select("class", "n", "vector"), tables, hashes, probes))

    entries = marks.select("class", "dim", F.posexplode("buckets").alias("pos", "bucket")).filter("bucket >= 0")
    entries = stored(entries.select("class", "dim", "bucket", (F.col("pos") % (1 + probes) == 0).alias("own")))
    shared = entries.groupBy("dim", "bucket").agg(F.count(F.lit(1)).alias("members"), F.count_if("own").alias("owners"))
    shared = stored(shared.filter("members > 1 and owners > 0").select("dim", "bucket", "members"))
    # Hot buckets are cut into parts by the join, and into blocks of members after it.
    blocks = F.ceil(F.col("members") / F.lit(block)).cast("int")
    met = join_counted(entries, shared, ["dim", "bucket"], "members", entries.count(), F.col("class"))
    met = met.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks").cast("bigint")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select(
        "class", "dim", "bucket", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    key = ["dim", "bucket", "i", "j"]
    tiles = met.join(marks.drop("dim"), "class").repartition(*[F.col(k) for k in key]).sortWithinPartitions(*key)
    found = stored(linked(tiles, least, tables))

    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    label = components(found.select(F.col("class").alias("u"), F.col("root").alias("v")))
    label = stored(label.withColumnsRenamed({"node": "class"}))
    sizes = label.join(classes.select("class", "first"), "class").groupBy("label").agg(F.min("first").alias("component"), F.count(F.lit(1)).alias("members"))
    labelled = join_counted(label, stored(sizes), ["label"], "members", label.count(), F.col("class"))
    known = classes.join(links, "class", "left").join(labelled.select("class", "component"), "class", "left")
    known = stored(
        known.select(
            "vector", F.col("n").alias("rows"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "first").alias("component_id"),
        )
    )
    joined = join_counted(rows.filter(fine), known, ["vector"], "rows", rows.count(), F.monotonically_increasing_id())
    alone = rows.filter(~fine).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    both = joined.select("id", "n_links", "component_id").union(alone)
    return both.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.col("id").isNull()))
