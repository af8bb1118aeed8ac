"""Exact duplicates by content-defined chunk recipes.

A text is cut where a rolling hash of its last bytes says so, hence equal texts are cut
alike and a changed byte moves few cuts. Every chunk's bytes travel once, to be compared
with the chunks of the same hash; from then on a chunk is a number. A document becomes the
ordered list of the numbers of its chunks, its recipe, and texts are equal exactly where
recipes are. Texts themselves are never shuffled whole and never travel again.

A chunk's identifier is (hash, ordinal): the ordinal tells apart chunks that share a hash
without being equal, so an identifier is verified by content, not trusted to the hash.

Defined cases: a null text counts as empty (one recipe with no chunks); rows that repeat an
id and a text are both reported with the same verdict; among equal texts the largest
non-null id stays, and null ids stay only where no id in the group is known; an empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from pagetide.llm.common import join_counted, text_of
from pagetide.sources.tables import stored

#: Cuts come about every 2**CUT_BITS bytes, and no chunk but the last is under MIN_CHUNK.
CUT_BITS = 11
MIN_CHUNK = 512
MAX_CHUNK = 16384


def gear_table() -> np.ndarray:
    """256 mixed 32-bit numbers, one per byte value (a multiplicative hash with shifts)."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


def rolling_hash(data: np.ndarray, gear: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes ending at each place: the sum of gear[byte k back] << k."""
    h = gear[data]
    for step in (1, 2, 4, 8, 16):
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    return h


def cut_ends(text: bytes, gear: np.ndarray) -> list[int]:
    """End of every chunk of one text, the last being the text's length."""
    n = len(text)
    if n <= MIN_CHUNK:
        return [n] if n else []
    h = rolling_hash(np.frombuffer(text, np.uint8), gear)
    marks = np.flatnonzero((h >> np.uint32(32 - CUT_BITS)) == 0) + 1
    ends, start = [], 0
    for mark in marks.tolist():
        while mark - start > MAX_CHUNK:
            start += MAX_CHUNK
            ends.append(start)
        if mark - start >= MIN_CHUNK:
            start = mark
            ends.append(start)
    while n - start > MAX_CHUNK:
        start += MAX_CHUNK
        ends.append(start)
    return ends if ends and ends[-1] == n else [*ends, n]


def chunk_ends(text: Column) -> Column:
    @F.pandas_udf("array<int>")
    def ends_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        gear = gear_table()
        for texts in batches:
            yield pd.Series([cut_ends(t.encode(), gear) for t in texts], dtype=object)

    return ends_of(text)


def _chunks(text: Column, ends: Column) -> Column:
    """The chunks as binaries, from the text and the ends of its chunks."""
    start = lambda i: F.when(i > 0, F.get(ends, i - 1)).otherwise(0)
    data = text.cast("binary")
    return F.transform(ends, lambda e, i: F.substring(data, start(i) + 1, e - start(i)))


@dataclass
class ChunkDedup:
    chunks: DataFrame  # hash, ordinal, bytes: every distinct chunk once
    recipes: DataFrame  # id, recipe, text_key
    classes: DataFrame  # recipe, keep_id, group_size


def chunked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text and the ends of the chunks."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return rows.withColumn("ends", chunk_ends(F.col("text")))


def dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    hash_of: Callable[[Column], Column] = F.xxhash64,
) -> ChunkDedup:
    """Chunk store, recipes and classes of equal texts."""
    cut = chunked(docs, id_col, text_col)
    distinct = (
        cut.select(F.explode(_chunks(F.col("text"), F.col("ends"))).alias("bytes"))
        .select(hash_of(F.col("bytes")).alias("hash"), "bytes")
        .distinct()
    )
    # The content travels once, here: per distinct chunk only the hash goes on. What shares
    # its hash with other content is a collision; as a rule there is none.
    shared = stored(distinct.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash"))
    own = F.transform("chunks", lambda c: F.struct(hash_of(c).alias("hash"), F.lit(0).alias("ordinal")))
    whole = cut.select(
        "id", F.sha2("text", 256).alias("text_key"), _chunks(F.col("text"), F.col("ends")).alias("chunks")
    )
    by_content = Window.partitionBy("hash").orderBy("bytes")
    if shared.isEmpty():
        store = distinct.withColumn("ordinal", F.lit(0))
        recipes = stored(whole.select("id", "text_key", own.alias("recipe")))
    else:
        collided = stored(
            distinct.join(shared, "hash", "left_semi").withColumn("ordinal", F.row_number().over(by_content) - 1)
        )
        store = distinct.join(collided, ["hash", "bytes"], "left").na.fill(0, ["ordinal"])
        recipes = stored(_with_ordinals(whole, collided, hash_of))
    classes = stored(
        recipes.groupBy("recipe").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    return ChunkDedup(store.select("hash", "ordinal", "bytes"), recipes, classes)


def _with_ordinals(whole: DataFrame, collided: DataFrame, hash_of: Callable[[Column], Column]) -> DataFrame:
    """Recipes where some hashes are shared: those chunks look their ordinal up by content."""
    rows = whole.withColumn("row", F.sha2(F.concat_ws(":", F.col("id").cast("string"), "text_key"), 256))
    found = (
        rows.select("row", F.posexplode("chunks").alias("seq", "bytes"))
        .distinct()
        .withColumn("hash", hash_of(F.col("bytes")))
        .join(collided, ["hash", "bytes"])
        .groupBy("row")
        .agg(F.map_from_entries(F.collect_list(F.struct("seq", "ordinal"))).alias("ordinals"))
    )
    ordinal = lambda i: F.coalesce(F.element_at("ordinals", i), F.lit(0))
    recipe = F.transform(
        "chunks", lambda c, i: F.struct(hash_of(c).alias("hash"), ordinal(i).alias("ordinal"))
    )
    return rows.join(found, "row", "left").select("id", "text_key", recipe.alias("recipe"))


def verdicts(found: ChunkDedup) -> DataFrame:
    """id, keep_id, group_size, kept, text_key: one row per document."""
    total = found.recipes.count()
    spread = F.coalesce(F.col("id").cast("string"), F.lit(""))
    return join_counted(found.recipes, found.classes, ["recipe"], "group_size", total, spread).select(
        "id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_key"
    )
