"""Near duplicates by SimHash: fingerprints, and a self-join of binary tries.

Fingerprints that differ in at most ``budget`` bits are linked. All pairs that do are found
without comparing all pairs: the fingerprints are the leaves of a binary trie, and pairs of
its nodes are walked together from the root, adding up the bits in which their paths differ
and dropping a pair as soon as the sum exceeds the budget.

One trie would meet most of its node pairs near the root, where nothing can be dropped yet.
So the bits are cut into ``blocks`` blocks. Two fingerprints with at most ``budget`` bits
between them agree in at least ``blocks - budget`` blocks. There is one trie for each choice
of so many blocks: it has their bits first and allows no difference in them, so its upper
levels only hold pairs of a node with itself, and walking them is a shuffle by the path. The
walk below them runs within one task, on sorted arrays whose ranges are the nodes. Every
linked pair is met in the trie of a choice in which it agrees, so no link is lost.

A node of more than ``node_rows`` leaves is not walked in one task: its pairs of nodes some
levels further down become tasks of their own, level after level.

A task returns links that span what it found connected, not all pairs: at most one row per
fingerprint. Components come from those links.

Defined cases: a null or wordless text has fingerprint zero and is linked like any other;
repeated rows and copies share a fingerprint; a component's id is the smallest non-null
document id in it, null if it has none; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from pagetide.llm.common import UPPER, join_counted, text_of
from pagetide.llm.components import components
from pagetide.sources.tables import stored

BITS = 64
BUDGET = 4
BLOCKS = 6
NODE_ROWS = 2_000_000
#: Levels by which an oversized pair of nodes is taken apart at a time.
STEP = 6
WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans(UPPER, UPPER.lower())


def fingerprint(text: str, width: int, seed: int = 42) -> int:
    """SimHash of the shingles of ``width`` words, with repeats, as an unsigned number."""
    words = WORD.findall(text.translate(LOWER))
    if not words:
        return 0
    joined = " ".join(words).encode()
    ends = np.cumsum([len(w.encode()) + 1 for w in words]) - 1
    n = max(1, len(words) - width + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[len(words) - n :].tolist()
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], seed) for a, b in zip(starts, stops)])
    ones = np.zeros(BITS, np.int64)
    rows = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(rows[at : at + (1 << 16)], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(text: Column, width: int) -> Column:
    """Fingerprint of each text, as the bigint of the same 64 bits."""

    @F.pandas_udf("bigint")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = np.fromiter((fingerprint(t, width) for t in texts), np.uint64, len(texts))
            yield pd.Series(found.view(np.int64))

    return of(text)


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- tries


def block_sizes(blocks: int) -> list[int]:
    return [BITS // blocks + (i < BITS % blocks) for i in range(blocks)]


def choices(blocks: int, budget: int) -> list[tuple[int, ...]]:
    """The blocks that come first in each trie."""
    if blocks <= budget:
        raise ValueError("there must be more blocks than differing bits")
    return list(combinations(range(blocks), blocks - budget))


def _leaf(fp: Column, first: tuple[int, ...], blocks: int) -> tuple[Column, int]:
    """The fingerprint with the blocks ``first`` in front, and their number of bits."""
    sizes = block_sizes(blocks)
    place = np.cumsum([0, *sizes])
    order = [*first, *(b for b in range(blocks) if b not in first)]
    out, used = F.lit(0).cast("bigint"), 0
    for b in order:
        used += sizes[b]
        bits = F.shiftrightunsigned(fp, int(BITS - place[b + 1])).bitwiseAND(F.lit((1 << sizes[b]) - 1))
        out = out.bitwiseOR(F.shiftleft(bits, BITS - used))
    return out, sum(sizes[b] for b in first)


def _node_pairs(prints: DataFrame, blocks: int, budget: int) -> DataFrame:
    """fp and its place in each trie; (trie, a, b, depth, diff) is the pair of nodes to walk.

    Every row is a leaf below node ``a`` or ``b``. At the start a pair is a node with itself.
    """
    rows = []
    for k, first in enumerate(choices(blocks, budget)):
        leaf, depth = _leaf(F.col("fp"), first, blocks)
        node = F.shiftrightunsigned(leaf, BITS - depth)
        rows.append(
            F.struct(
                F.lit(k).alias("trie"), leaf.alias("leaf"), node.alias("a"), node.alias("b"),
                F.lit(depth).alias("depth"), F.lit(0).alias("diff"),
            )
        )
    return prints.select("fp", F.explode(F.array(*rows)).alias("r")).select("fp", "r.*")


PAIR = ["trie", "a", "b", "depth", "diff"]


def _take_apart(rows: DataFrame, budget: int) -> DataFrame:
    """The pairs of nodes STEP levels below that exist and are within the budget."""
    masks = [m for m in range(1 << STEP) if m.bit_count() <= budget]
    rows = rows.withColumn("kid", F.expr(f"shiftrightunsigned(leaf, {BITS} - depth - {STEP})"))
    kids = rows.select(*PAIR, "kid").distinct()
    parent = F.shiftrightunsigned("kid", STEP)
    low = F.col("kid").bitwiseAND(F.lit((1 << STEP) - 1))
    partners = F.transform(
        F.lit(masks), lambda m: F.struct(F.shiftleft("b", STEP).bitwiseOR(low.bitwiseXOR(m)).alias("nb"), F.bit_count(m).alias("more"))
    )
    below_a = kids.filter(parent == F.col("a")).select(*PAIR, F.col("kid").alias("na"), F.inline(partners))
    below_b = kids.filter(parent == F.col("b")).select(*PAIR, F.col("kid").alias("nb"))
    same = F.col("a") == F.col("b")
    pairs = below_a.filter(F.col("diff") + F.col("more") <= budget).join(below_b, [*PAIR, "nb"]).select(
        *PAIR, "more",
        F.when(same, F.least("na", "nb")).otherwise(F.col("na")).alias("na"),
        F.when(same, F.greatest("na", "nb")).otherwise(F.col("nb")).alias("nb"),
    )
    # A leaf goes to every pair that its own node is part of.
    sides = pairs.select(*PAIR, "more", "na", "nb", F.explode(F.array("na", "nb")).alias("kid")).distinct()
    return rows.join(sides, [*PAIR, "kid"]).select(
        "fp", "trie", "leaf", F.col("na").alias("a"), F.col("nb").alias("b"),
        (F.col("depth") + STEP).alias("depth"), (F.col("diff") + F.col("more")).alias("diff"),
    )


class Trie:
    """Sorted leaves; a node is the range of leaves below it."""

    def __init__(self, leaves: np.ndarray):
        self.leaves = leaves
        self.labels = np.arange(len(leaves))
        self.changes = np.arange(len(leaves) + 1)

    def ones(self, bit: np.ndarray) -> np.ndarray:
        return (self.leaves >> np.uint64(bit)) & np.uint64(1)

    def connect(self, x: np.ndarray, y: np.ndarray) -> None:
        """Join the groups of the leaves x[i] and y[i]; labels are the smallest members."""
        if not len(x):
            return
        labels = self.labels
        while True:
            p, q = labels[x], labels[y]
            apart = p != q
            if not apart.any():
                break
            x, y, p, q = x[apart], y[apart], p[apart], q[apart]
            np.minimum.at(labels, np.maximum(p, q), np.minimum(p, q))
            while True:
                up = labels[labels]
                if (up == labels).all():
                    break
                labels[:] = up
        self.changes = np.concatenate([[0, 0], np.cumsum(labels[1:] != labels[:-1])])

    def settled(self, a0, a1, b0, b1) -> np.ndarray:
        """Pairs whose leaves are all connected already."""
        c, labels = self.changes, self.labels
        one_a, one_b = c[a1] == c[a0 + 1], c[b1] == c[b0 + 1]
        return one_a & one_b & (labels[a0] == labels[b0])

    def walk(self, pairs: np.ndarray, depth: int, budget: int, small: int = 16, front: int = 1 << 18) -> None:
        """Walk node pairs (a0, a1, b0, b1, diff) of one depth down to the leaves."""
        stack = [(pairs, depth)]
        totals: dict[int, np.ndarray] = {}
        while stack:
            pairs, depth = stack.pop()
            if len(pairs) > front:
                half = len(pairs) // 2
                stack += [(pairs[half:], depth), (pairs[:half], depth)]
                continue
            a0, a1, b0, b1, diff = pairs.T
            open_ = ~self.settled(a0, a1, b0, b1)
            tiny = (a1 - a0) * (b1 - b0) <= small
            self._compare(pairs[open_ & tiny], budget)
            pairs = pairs[open_ & ~tiny]
            if not len(pairs) or depth == BITS:
                continue
            a0, a1, b0, b1, diff = pairs.T
            if depth not in totals:
                totals[depth] = np.concatenate([[0], np.cumsum(self.ones(BITS - 1 - depth).astype(np.int64))])
            t = totals[depth]
            am, bm = a1 - (t[a1] - t[a0]), b1 - (t[b1] - t[b0])
            same = (a0 == b0) & (a1 == b1)
            below = [
                np.stack([a0, am, b0, bm, diff], 1),
                np.stack([am, a1, bm, b1, diff], 1),
                np.stack([a0, am, bm, b1, diff + 1], 1),
                np.stack([am, a1, b0, bm, diff + 1], 1)[~same],
            ]
            below = np.concatenate(below)
            full = (below[:, 1] > below[:, 0]) & (below[:, 3] > below[:, 2]) & (below[:, 4] <= budget)
            stack.append((below[full], depth + 1))

    def _compare(self, pairs: np.ndarray, budget: int) -> None:
        """All leaves of small nodes with each other."""
        if not len(pairs):
            return
        a0, a1, b0, b1, _ = pairs.T
        n = (a1 - a0) * (b1 - b0)
        at = np.repeat(np.arange(len(n)), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        x, y = a0[at] + k // (b1 - b0)[at], b0[at] + k % (b1 - b0)[at]
        near = np.bitwise_count(self.leaves[x] ^ self.leaves[y]) <= budget
        self.connect(x[near & (x != y)], y[near & (x != y)])


def _ranges(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal rows."""
    new = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
    return new, np.r_[new[1:], len(keys)]


def _links(rows: pd.DataFrame, budget: int) -> pd.DataFrame:
    """Spanning links of the node pairs in ``rows``, which are sorted by pair and leaf."""
    fp, leaves = rows["fp"].to_numpy(), rows["leaf"].to_numpy().view(np.uint64)
    keys = rows[PAIR].to_numpy(np.int64)
    start, end = _ranges(keys)
    some = end - start > 1
    start, end = start[some], end[some]
    found = []
    depths, diffs = keys[start, 3], keys[start, 4]
    a, b = keys[start, 1], keys[start, 2]
    for depth in np.unique(depths):
        mine = depths == depth
        trie = Trie(leaves)
        s, e = start[mine], end[mine]
        # In a pair of two nodes the leaves of ``a`` come first where a < b as sorted.
        node = (leaves >> np.uint64(BITS - int(depth))).astype(np.int64) if depth < BITS else leaves.view(np.int64)
        count = np.concatenate([[0], np.cumsum(node == np.repeat(keys[:, 1], 1))])
        in_a = count[e] - count[s]
        a_first = node[s] == a[mine]
        same = a[mine] == b[mine]
        cut = np.where(a_first, s + in_a, e - in_a)
        pairs = np.stack([
            s, np.where(same, e, cut), np.where(same, s, cut), e, diffs[mine],
        ], 1)
        pairs = pairs[(pairs[:, 1] > pairs[:, 0]) & (pairs[:, 3] > pairs[:, 2])]
        # Near links first: what they connect need not be walked again for wider ones.
        for within in range(1, budget + 1):
            trie.walk(pairs[pairs[:, 4] <= within], int(depth), within)
        linked = np.flatnonzero(trie.labels != np.arange(len(leaves)))
        found.append(pd.DataFrame({"u": fp[linked], "v": fp[trie.labels[linked]]}))
    return pd.concat(found) if found else pd.DataFrame({"u": fp[:0], "v": fp[:0]})


def _walker(budget: int, batch: int = 200_000):
    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Gathers whole node pairs, ``batch`` leaves or one pair at a time."""
        waiting: list[pd.DataFrame] = []
        size = 0
        for frame in frames:
            waiting.append(frame)
            size += len(frame)
            if size >= batch:
                rows = pd.concat(waiting)
                keys = rows[PAIR].to_numpy(np.int64)
                cut = _ranges(keys)[0][-1]  # the last pair may go on in the next frame
                if cut:
                    yield _links(rows.iloc[:cut], budget)
                waiting, size = [rows.iloc[cut:]], len(rows) - cut
        if size:
            yield _links(pd.concat(waiting), budget)

    return walk


def near_links(
    prints: DataFrame, budget: int = BUDGET, blocks: int = BLOCKS, node_rows: int = NODE_ROWS
) -> DataFrame:
    """(u, v): links that span the groups of distinct fingerprints ``prints(fp)``."""
    rows = _node_pairs(prints, blocks, budget)
    ready: list[DataFrame] = []
    while True:
        sizes = rows.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n"))
        # Oversized pairs: at most (blocks choose budget) * N / node_rows of them.
        large = stored(sizes.filter((F.col("n") > node_rows) & (F.col("depth") + STEP <= BITS)).select(*PAIR))
        if large.isEmpty():
            break
        ready.append(rows.join(large, PAIR, "left_anti"))
        rows = stored(_take_apart(rows.join(large, PAIR, "left_semi"), budget))
    for other in ready:
        rows = rows.unionByName(other)
    return (
        rows.repartition("trie", "a", "b", "depth")
        .sortWithinPartitions("trie", "a", "b", "depth", "diff", "leaf")
        .mapInPandas(_walker(budget), "u bigint, v bigint")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 4,
    budget: int = BUDGET,
    blocks: int = BLOCKS,
    node_rows: int = NODE_ROWS,
) -> DataFrame:
    """id, fp, component_id, text_key of every row."""
    text = text_of(text_col)
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"), fingerprints(text, width).alias("fp"), F.sha2(text, 256).alias("text_key")
        )
    )
    prints = stored(rows.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")))
    groups = stored(components(stored(near_links(prints.select("fp"), budget, blocks, node_rows))))
    named = prints.join(groups, prints["fp"] == groups["node"], "left").select(
        "fp", "first", "n", F.coalesce("label", "fp").alias("label")
    )
    named = stored(named)
    per_group = stored(
        named.groupBy("label").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("m"))
    )
    total_prints = named.count()
    labelled = stored(
        join_counted(named, per_group, ["label"], "m", total_prints, F.col("fp")).select("fp", "n", "component_id")
    )
    spread = F.coalesce(F.col("id").cast("string"), F.lit(""))
    return join_counted(rows, labelled, ["fp"], "n", rows.count(), spread).select(
        "id", "fp", "component_id", "text_key"
    )
