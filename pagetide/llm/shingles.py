"""Near copies by the similarity of their shingle sets.

Two texts are linked if the sets of their groups of ``width`` words have a Jaccard similarity
of at least ``similar``. Every link is verified on the sets themselves.

Candidates come from the SimHash trie self-join (``simhash.near_links``, here on shingles of
``WIDTH`` words): fingerprints within its budget. A SimHash of 64 bits differs in about 10 bits at 0.8,
and unrelated prints are within such a budget so often that walking them grows with the square of
the corpus. So the pairs beyond the budget come from buckets: the smallest values of the set under
``ROWS`` hash functions, taken together, for one of ``BANDS`` choices of functions. Two sets of
similarity s share one with probability 1 - (1 - s**ROWS)**BANDS: all but 7 pairs in 100,000 at 0.8,
fewer above.

First the pairs of the tries, and each text of a bucket with the bucket's smallest, are compared. Buckets that this leaves
in more than one component are compared in full, in blocks of bounded size, and give links
that span what is connected. Pairs are never listed; buckets with equal members are compared once.

Defined cases: case of A-Z is ignored; a text of fewer than ``width`` words is one shingle, a
null or wordless text the empty one, so such texts are alike; repeated rows are one text.
Texts are told apart by 128 bits of their SHA-256 here.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from pagetide.llm.common import join_counted, text_of
from pagetide.llm.components import components
from pagetide.llm.simhash import LOWER, WORD, fingerprint, near_links
from pagetide.sources.tables import stored

WIDTH = 5
#: Least similarity as a fraction, so that the comparison is one of whole numbers.
SIMILAR = (4, 5)
BANDS, ROWS = 24, 5
#: Shingles in a block of a bucket; a task compares two blocks.
BLOCK = 1_000_000


def name_of(text: Column) -> Column:
    """What stands for a text: 16 bytes of its digest."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the groups of ``width`` words."""
    words = WORD.findall(text.translate(LOWER))
    joined = " ".join(words).encode()
    ends = np.cumsum([len(w.encode()) + 1 for w in words] or [1]) - 1
    n = max(1, len(words) - width + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[len(ends) - n :].tolist()
    digest = xxhash.xxh64_digest
    return np.unique(np.frombuffer(b"".join([digest(joined[a:b]) for a, b in zip(starts, stops)]), np.uint64))


def bucket_keys(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per band, of the smallest values under its hash functions."""
    rng = np.random.default_rng(42)
    times, plus = rng.integers(1 << 63, size=(2, bands * rows, 1), dtype=np.uint64)
    least = np.full(bands * rows, ~np.uint64(0))
    for at in range(0, len(grams), 2048):
        least = np.minimum(least, (grams[at : at + 2048] * (2 * times + np.uint64(1)) + plus).min(1))
    least = least.reshape(bands, rows)
    return np.array([xxhash.xxh64_intdigest(least[k].tobytes(), k) for k in range(bands)], np.uint64).view(np.int64)


def signatures(text: Column, width: int, bands: int, rows: int) -> Column:
    """struct(fp, bands): fingerprint and bucket keys of each text.

    One function for both: each of two would have a Python worker of its own in every task.
    """

    @F.pandas_udf("fp bigint, bands array<bigint>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            prints = np.fromiter((fingerprint(t, width) for t in texts), np.uint64, len(texts))
            keys = [bucket_keys(shingles(t, width), bands, rows) for t in texts]
            yield pd.DataFrame({"fp": prints.view(np.int64), "bands": pd.Series(keys, dtype=object)})

    return of(text)


def shingles_of(text: Column, width: int) -> Column:
    @F.pandas_udf("array<bigint>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shingles(t, width).view(np.int64) for t in texts], dtype=object)

    return of(text)


def spanning(sets: list[np.ndarray], labels: np.ndarray, left: np.ndarray, right: np.ndarray, similar: tuple[int, int],
             cells: int = 1 << 22) -> list[tuple[int, int]]:
    """Links (i, j) of ``left`` to ``right`` that span the components by similarity.

    ``labels`` are components known before; pairs within one are not compared again.
    """
    over, under = similar
    _, label = np.unique(labels, return_inverse=True)
    size = np.array([len(s) for s in sets])
    # Postings of the right side: which of its sets hold a shingle.
    gram = np.concatenate([sets[j] for j in right])
    order = np.argsort(gram, kind="stable")
    gram, owner = gram[order], np.repeat(np.arange(len(right)), size[right])[order]
    links = []
    step = max(1, cells // len(right))
    queue = [left[k : k + step] for k in range(0, len(left), step)]
    while queue:
        part = queue.pop()
        if len(np.unique(label[np.concatenate([part, right])])) == 1:
            continue
        mine = np.concatenate([sets[i] for i in part])
        first, last = np.searchsorted(gram, mine), np.searchsorted(gram, mine, "right")
        n = last - first
        if n.sum() > cells and len(part) > 1:
            queue += [part[: len(part) // 2], part[len(part) // 2 :]]
            continue
        row = np.repeat(np.repeat(np.arange(len(part)), size[part]), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        both = np.bincount(row * len(right) + owner[at], minlength=len(part) * len(right)).reshape(len(part), -1)
        total = size[part][:, None] + size[right][None, :]
        near = (over + under) * both >= over * total
        near &= label[part][:, None] != label[right][None, :]
        for i, j in zip(*np.nonzero(near)):
            a, b = label[part[i]], label[right[j]]
            if a != b:
                label[label == b] = a
                links.append((part[i], right[j]))
    return links


def _open_links(rows: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """(u, v): links within the pairs of blocks ``rows(band, i, j, block, t, label, grams)``."""

    def of(frame: pd.DataFrame) -> pd.DataFrame:
        t, block = frame["t"].to_numpy(), frame["block"].to_numpy()
        i, j = frame["i"].iloc[0], frame["j"].iloc[0]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        found = spanning(list(frame["grams"]), frame["label"].to_numpy(), left, right, similar) if len(left) and len(right) else []
        return pd.DataFrame({"u": [t[a] for a, _ in found], "v": [t[b] for _, b in found]}, dtype=object)

    return rows.groupBy("band", "i", "j").applyInPandas(of, "u binary, v binary")


def trie_pairs(rows: DataFrame) -> DataFrame:
    """(t, lead): pairs of texts that span the groups of near fingerprints of ``rows(t, fp)``."""
    texts = stored(rows.select("t", "fp").distinct())
    prints = stored(texts.groupBy("fp").agg(F.min("t").alias("lead"), F.count(F.lit(1)).alias("n")))
    same = join_counted(texts, prints, ["fp"], "n", texts.count(), F.col("t")).select("t", "lead")
    links = stored(near_links(prints.select("fp")))
    # One print may be linked to very many.
    leads = prints.select(F.col("fp").alias("v"), "lead").join(links.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "v")
    across = join_counted(links, stored(leads), ["v"], "n", links.count(), F.col("u")).select(F.col("u").alias("fp"), "lead")
    across = across.join(prints.select("fp", F.col("lead").alias("t")), "fp").select("t", "lead")
    return same.union(across).filter("t <> lead")


def similar_links(
    docs: DataFrame, rows: DataFrame, text_col: str, width: int, similar: tuple[int, int], block: int
) -> DataFrame:
    """(u, v): links that span the components of the texts of ``rows(t, fp, bands)``."""
    over, under = similar
    pairs = stored(trie_pairs(rows))
    members = stored(rows.select("t", F.explode("bands").alias("band")).distinct())
    buckets = members.groupBy("band").agg(F.min("t").alias("lead"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stored(
        join_counted(members, stored(buckets), ["band"], "n", members.count(), F.col("t")).select("band", "t", "lead")
    )
    texts = docs.select(name_of(text_of(text_col)).alias("t"), text_of(text_col).alias("text")).dropDuplicates(["t"])
    asked = shared.select("t").union(pairs.select("t")).union(pairs.select("lead")).distinct()
    sets = texts.join(asked, "t", "left_semi").select(
        "t", shingles_of(F.col("text"), width).alias("grams")
    )
    sets = stored(sets.withColumn("size", F.size("grams")))

    # The pairs of the tries, and every text with the smallest of its buckets.
    stars = stored(pairs.union(shared.filter("t <> lead").select("t", "lead")).distinct())
    leads = sets.withColumnsRenamed({"t": "lead", "grams": "lead_grams", "size": "lead_size"}).join(
        stars.groupBy("lead").agg(F.count(F.lit(1)).alias("n")), "lead"
    )
    both = F.size(F.array_intersect("grams", "lead_grams"))
    total = F.col("size") + F.col("lead_size")
    links = stored(
        join_counted(stars.join(sets, "t"), stored(leads), ["lead"], "n", stars.count(), F.col("t"))
        .filter((over + under) * both >= over * total)
        .select(F.col("t").alias("u"), F.col("lead").alias("v"))
    )

    # Buckets still in more than one component; one of two texts has been compared in full.
    known = components(links).select(F.col("node").alias("t"), "label")
    known = stored(sets.select("t", "size").join(known, "t", "left").withColumn("label", F.coalesce("label", "t")))
    shared = stored(shared.select("band", "t").join(known, "t"))
    opened = (
        shared.groupBy("band")
        .agg(
            F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n"),
            F.ceil(F.sum("size") / block).cast("int").alias("blocks"),
            *[F.sum(F.xxhash64(F.lit(k), "t").cast("decimal(38,0)")).alias(f"same{k}") for k in (1, 2)],
        )
        .filter("low <> high and n > 2")
        .groupBy("n", "same1", "same2")
        .agg(F.min("band").alias("band"), F.first("blocks").alias("blocks"))
    )
    opened = stored(opened.select("band", "n", "blocks"))
    rows = join_counted(shared, opened, ["band"], "n", shared.count(), F.col("t"))
    own = F.pmod(F.xxhash64("t"), F.col("blocks").cast("bigint")).cast("int")
    rows = (
        rows.withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .join(sets.select("t", "grams"), "t")
        .select("band", "i", "j", "block", "t", "label", "grams")
    )
    return links.union(_open_links(rows, similar))


def near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    similar: tuple[int, int] = SIMILAR,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """id, text_key, label of every row; rows of one label are linked."""
    text = text_of(text_col)
    read = stored(
        docs.select(
            F.col(id_col).alias("id"), name_of(text).alias("t"), F.sha2(text, 256).alias("text_key"),
            signatures(text, width, bands, rows).alias("found"),
        ).select("id", "t", "text_key", "found.*")
    )
    groups = components(similar_links(docs, read, text_col, width, similar, block))
    groups = groups.select(F.col("node").alias("t"), "label")
    counted = stored(groups.join(read.groupBy("t").agg(F.count(F.lit(1)).alias("n")), "t"))
    spread = F.coalesce(F.col("id").cast("string"), F.lit(""))
    return join_counted(read.drop("bands", "fp"), counted, ["t"], "n", read.count(), spread, "left").select(
        "id", "text_key", F.coalesce("label", "t").alias("label")
    )


def kept_of(found: DataFrame) -> DataFrame:
    """_id, _key, _n: the pair that stays of each label, smallest non-null id first, and its rows."""
    pairs = found.groupBy("label", "id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_key", "n")).alias("first")
    return pairs.groupBy("label").agg(first).select(
        F.col("first.id").alias("_id"), F.col("first.text_key").alias("_key"), F.col("first.n").alias("_n")
    )
