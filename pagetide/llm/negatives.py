"""Hard negatives: rows of another label that score nearly as high as a positive.

Scores are integer inner products. An anchor's positives are the rows of its label with the
highest scores; for each of them, the negatives are the best rows of other labels within a
window of scores below the positive's own.

Slots: the windows of one anchor overlap, but their upper limits cut the scores into disjoint
slots. A task keeps the best rows of every (anchor, slot), which are merged over tasks. The
best rows up to a limit are those of its slot and of all lower ones, slots in descending order
and each slot in its own order: one list per anchor, of which every window takes the head from
its own slot on. As the list descends, a window's lower limit only cuts its end.

All rows are packed into blocks of ``chunk`` rows, and anchors into blocks of about
``anchor_block``. Blocks meet by an equi join on the number of the anchors' block and a part of
the rows' blocks, so that work spreads evenly whatever the labels; a pair of blocks gives at
most anchors x slots x k rows.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take no
part. Shorter vectors count as ending in zeros, an empty vector scores 0. Rows are told apart by
place: repeated rows are other rows to each other, and a repeated anchor is mined once per row.
A null id is no anchor by ``anchor`` being null, and comes last in ties. Anchors without positives,
and positives without negatives, give no rows. Other columns are not read. Scores beyond 64 bits
raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from pagetide.llm.common import parallelism
from pagetide.sources.tables import stored

#: A null id in ties, and in the blocks.
NO_ID = np.iinfo(np.int64).max
#: Up to here whole numbers in doubles are exact.
EXACT = 2.0**53

#: Blocks of anchors that a task has in hand at a time.
STATES = 16

CHUNKS = "block bigint, dim int, ids binary, labels binary, anchors binary, vectors binary"


def finite(vector: Column) -> Column:
    """Whether the vector is there and has finite components only."""
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return vector.isNotNull() & fine


def vectors_of(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The components one after the other, and the length of each vector."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(lists.flatten(), np.float64), np.asarray(lists.value_lengths(), np.int64)


def padded(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    dim = int(sizes.max(initial=0))
    if (sizes == dim).all():
        return flat.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def packed(rows: DataFrame, chunk: int) -> DataFrame:
    """Blocks of ``rows(id, label, anchor, vector)``, in each ordered by id."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting, size = TaskContext.get().partitionId() << 32, [], 0

        def block() -> pa.RecordBatch:
            nonlocal number, waiting, size
            table = pa.Table.from_batches(waiting).combine_chunks()
            now, later = table.slice(0, chunk), table.slice(chunk)
            waiting, size = later.to_batches(), later.num_rows
            ids = np.asarray(now["id"].fill_null(NO_ID), np.int64)
            order = np.argsort(ids, kind="stable")
            vectors = np.floor(256.0 * padded(*vectors_of(now["vector"])))
            if np.abs(vectors).max(initial=0) < 2**24:
                vectors = vectors.astype(np.float32)  # as exact, in half the room
            columns = [
                ids[order], np.asarray(now["label"], np.int64)[order],
                np.asarray(now["anchor"].cast(pa.uint8()), np.uint8)[order], vectors[order],
            ]
            out = pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([vectors.shape[1]], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in columns)],
                names=["block", "dim", "ids", "labels", "anchors", "vectors"],
            )
            number += 1
            return out

        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                size += batch.num_rows
            while size >= chunk:
                yield block()
        while size:
            yield block()

    return rows.mapInArrow(pack, CHUNKS)


def matrix(row: dict, rows: int) -> np.ndarray:
    """The vectors of a block as doubles."""
    cells = rows * row["dim"]
    kind = np.float32 if len(row["vectors"]) == 4 * cells else np.float64
    return np.frombuffer(row["vectors"], kind).reshape(rows, row["dim"]).astype(np.float64)


def anchors_in(chunks: DataFrame) -> DataFrame:
    """block, at, id, label, vector of the rows that are anchors."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                flags = np.frombuffer(row["anchors"], np.uint8)
                at = np.flatnonzero(flags)
                vectors = matrix(row, len(flags))[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at), row["block"])), pa.array(at.astype(np.int32)),
                        pa.array(np.frombuffer(row["ids"], np.int64)[at]), pa.array(np.frombuffer(row["labels"], np.int64)[at]),
                        pa.array([v.tobytes() for v in vectors], pa.binary()),
                    ],
                    names=["block", "at", "id", "label", "vector"],
                )

    return chunks.mapInArrow(take, "block bigint, at int, id bigint, label bigint, vector binary")


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products, as 64-bit numbers."""
    dim = min(left.shape[1], right.shape[1])
    left, right = left[:, :dim], right[:, :dim]
    most = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * dim
    if most < EXACT:
        return (left @ right.T).astype(np.int64)
    exact = [[int(x) for x in row] for row in left], [[int(x) for x in row] for row in right]
    return np.array([[sum(a * b for a, b in zip(x, y)) for y in exact[1]] for x in exact[0]], dtype=object).astype(np.int64)


class Best:
    """The best rows of every anchor of a block in every slot, over the row blocks seen so far."""

    def __init__(self, anchors: list[dict], same: bool, k: int):
        self.same, self.k = same, k
        self.block = np.array([a["block"] for a in anchors], np.int64)
        self.at = np.array([a["at"] for a in anchors], np.int64)
        self.labels = np.array([a["label"] for a in anchors], np.int64)
        vectors = [np.frombuffer(a["vector"]) for a in anchors]
        self.vectors = padded(np.concatenate(vectors), np.array([len(v) for v in vectors]))
        self.slots = max(len(a["limits"]) for a in anchors) - 1
        # Of slot s the scores are above limits[s + 1] and at most limits[s].
        least = np.iinfo(np.int64).min
        self.limits = np.array([a["limits"] + [least] * (self.slots + 1 - len(a["limits"])) for a in anchors], np.int64)
        self.below = np.array([a["limits"][-1] for a in anchors], np.int64)
        shape = (len(anchors), self.slots, k)
        self.scores, self.ids = np.full(shape, least), np.full(shape, NO_ID)
        self.found = np.zeros(shape, bool)

    def add(self, row: dict) -> None:
        labels, ids = np.frombuffer(row["labels"], np.int64), np.frombuffer(row["ids"], np.int64)
        scores = products(self.vectors, matrix(row, len(ids)))
        fits = (self.labels[:, None] == labels[None, :]) == self.same
        own = np.flatnonzero(self.block == row["row_block"])
        fits[own, self.at[own]] = False
        fits &= (scores <= self.limits[:, :1]) & (scores > self.below[:, None])
        # Only anchors and rows that fit at all are ordered, by slot, score and id.
        a, r = np.nonzero(fits)
        s = scores[a, r]
        slot = (s[:, None] <= self.limits[a, 1 : self.slots]).sum(axis=1)
        group = a * self.slots + slot
        order = np.lexsort((r, ~s, group))  # a row block is ordered by id
        group, s, r = group[order], s[order], r[order]
        place = np.arange(len(group)) - np.searchsorted(group, group)
        keep = place < self.k
        a, slot, place = group[keep] // self.slots, group[keep] % self.slots, place[keep]
        new_scores, new_ids, new_found = np.full_like(self.scores, np.iinfo(np.int64).min), np.full_like(self.ids, NO_ID), np.zeros_like(self.found)
        new_scores[a, slot, place], new_ids[a, slot, place], new_found[a, slot, place] = s[keep], ids[r[keep]], True
        both = [np.concatenate(x, axis=2) for x in ((self.scores, new_scores), (self.ids, new_ids), (self.found, new_found))]
        order = np.lexsort((both[1], ~both[0], ~both[2]), axis=2)[:, :, : self.k]  # ~x descends as x ascends
        self.scores, self.ids, self.found = (np.take_along_axis(x, order, 2) for x in both)

    def batch(self) -> pa.RecordBatch:
        a, slot, place = np.nonzero(self.found)
        ids = self.ids[a, slot, place]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.block[a]), pa.array(self.at[a].astype(np.int32)), pa.array(slot.astype(np.int32)),
                pa.array(self.scores[a, slot, place]), pa.array(ids, mask=ids == NO_ID),
            ],
            names=["block", "at", "slot", "score", "id"],
        )


def best_rows(chunks: DataFrame, anchors: DataFrame, total: int, same: bool, k: int, anchor_block: int) -> DataFrame:
    """block, at, slot, score, id, place: the best ``k`` rows of every (anchor, slot).

    ``anchors`` has block, at, label, vector, limits. A task holds the state of a few blocks
    of anchors, merges what its row blocks bring, and gives out each once.
    """
    spark = chunks.sparkSession
    blocks = max(1, -(-total // anchor_block))
    parts = max(1, -(-2 * parallelism(spark) // blocks))
    columns = ["block", "at", "label", "vector", "limits"]
    grouped = (
        anchors.groupBy(F.pmod(F.xxhash64("block", "at"), F.lit(blocks)).alias("group"))
        .agg(F.collect_list(F.struct(*columns)).alias("anchors"))
        .select("group", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "anchors")
    )
    spread = chunks.select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("group"),
        F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int").alias("part"),
        F.col("block").alias("row_block"), "dim", "ids", "labels", "vectors",
    )
    met = spread.join(grouped, ["group", "part"])

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, states = ("row_block", "dim", "ids", "labels", "vectors"), {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                group = row.column("group")[0].as_py()
                if group not in states:
                    if len(states) >= STATES:
                        yield states.pop(next(iter(states))).batch()
                    states[group] = Best(row.column("anchors")[0].as_py(), same, k)
                states[group].add({n: row.column(n)[0].as_py() for n in names})
        for best in states.values():
            yield best.batch()

    found = met.mapInArrow(select, "block bigint, at int, slot int, score bigint, id bigint")
    order = Window.partitionBy("block", "at", "slot").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def mine(
    rows: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    chunk: int = 2048,
    anchor_block: int = 512,
) -> DataFrame:
    """anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score.

    ``anchor`` says which rows are anchors. Components become floor(256 x). ``window`` has the
    least and the largest percentage of the positive's score that a negative's may have.
    """
    low, high = window
    rows = rows.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector_col).cast("array<double>").alias("vector"),
    ).filter(F.col("label").isNotNull() & finite(F.col("vector")))
    chunks = stored(packed(rows, chunk))
    anchors = stored(anchors_in(chunks))
    total = anchors.count()

    any_score = F.array(F.lit(2**63 - 1), F.lit(-(2**63)))
    best = best_rows(chunks, anchors.withColumn("limits", any_score), total, True, positives, anchor_block)
    percent = lambda p: F.col("score").cast("decimal(38,0)") * F.lit(p)
    mine_ = best.select(
        "block", "at", F.col("id").alias("positive_id"), F.col("place").alias("positive_rank"),
        F.col("score").alias("positive_score"),
        F.ceil(percent(low) / 100).cast("bigint").alias("least"), F.floor(percent(high) / 100).cast("bigint").alias("most"),
    )
    mine_ = stored(mine_.filter("least <= most"))

    # The limits of an anchor in descending order, and below them the least score of any window.
    limits = mine_.groupBy("block", "at").agg(
        F.sort_array(F.collect_set("most"), asc=False).alias("most"), (F.min("least") - 1).alias("below")
    )
    limits = limits.select("block", "at", F.concat("most", F.array("below")).alias("limits"))
    asked = stored(anchors.join(limits, ["block", "at"]))
    best = best_rows(chunks, asked, total, False, negatives, anchor_block)

    # Descending suffixes: from the slot of a limit on, in the order of slots and places.
    lists = best.groupBy("block", "at").agg(F.sort_array(F.collect_list(F.struct("slot", "place", "score", "id"))).alias("found"))
    slot = F.expr("array_position(limits, most) - 1")
    windows = mine_.join(asked.select("block", "at", F.col("id").alias("anchor_id"), "limits"), ["block", "at"])
    head = F.expr(f"slice(filter(found, x -> x.slot >= own), 1, {int(negatives)})")
    found = windows.withColumn("own", slot).join(lists, ["block", "at"]).withColumn("head", head)
    return (
        found.select("*", F.posexplode(F.expr("filter(head, x -> x.score >= least)")).alias("pos", "negative"))
        .select(
            "anchor_id", "positive_id", "positive_rank", (F.col("pos") + 1).alias("rank"),
            F.col("negative.id").alias("negative_id"), "positive_score", F.col("negative.score").alias("negative_score"),
        )
    )
