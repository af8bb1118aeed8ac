"""Frequent word pairs, triples and quadruples of each language, scored as collocations.

Stripes: a prefix of none to three words keys an associative counter of the words that follow
it. A task gathers the stripes of its texts, those of prefixes with one first word in one row,
the stripes of a prefix are merged elementwise, and everything else is read off the merged stripes:

- an entry is the count of an extension, i.e. of a longer phrase,
- the total of a prefix is the entry of its last word in the stripe of the words before it (the
  stripe of the empty prefix counts single words),
- the largest entry of a stripe, and of all stripes that end alike but for their first word,
  says whether a phrase lies inside a longer one that is nearly as frequent. Counts never grow
  with length, so the longer phrases with one more word decide.

A phrase is frequent only if all its parts are, so the table is read once per length: words
first, then stripes of one word with frequent words only, then those of two words whose pairs are
frequent, then those of three. What is frequent reaches the tasks as one bit per hash. A hash that is set by
chance only costs work, never a result, so the bits have a size that the input cannot exceed
(``MOST_BITS``). Stripes whose prefix begins with a very common word are merged in ``SHARDS`` parts
by their next words; there are at most 4 * spark.sql.shuffle.partitions such words.

Defined cases: a null text is an empty one, a null language is ``und``; repeated rows count as
often as they occur; an empty table, or one without frequent phrases, gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pagetide.llm.common import UPPER, join_counted, part_rows, text_of
from pagetide.sources.tables import stored

#: Characters that end a piece become full stops, white space within one becomes a blank.
TABLE = bytes.maketrans(UPPER.encode() + b",;:!?\n\x0b\x0c\r\t", UPPER.lower().encode() + b"......... ")
#: No word is a full stop; it stands between pieces and has code 0.
BREAK = b"."
LONGEST = 4
#: Bytes of text that are split into words at a time, and words gathered before stripes are given out.
SLICE, GATHERED = 4_000_000, 2_000_000
SHARDS = 16
#: 2**28 bits, 32 MB: the largest filter of frequent words or pairs.
MOST_BITS = 28


def pieces_of(data: bytes) -> Iterator[list[bytes]]:
    """Words of a text, and breaks, in slices that end between words."""
    data, at = data.translate(TABLE), 0
    while at < len(data):
        end = at + SLICE
        if end < len(data):
            cut = max(data.rfind(b" ", at, end), data.rfind(BREAK, at, end))
            if cut < at:  # one word fills the slice
                ends = [p for p in (data.find(b" ", end), data.find(BREAK, end)) if p >= 0]
                cut = min(ends, default=len(data) - 1)
            end = cut + 1
        yield data[at:end].replace(BREAK, b" . ").split()
        at = end


class Codes(dict):
    """Numbers of words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


@dataclass
class Words:
    """The words of one language that wait to be counted."""

    lang: str
    codes: Codes = field(default_factory=lambda: Codes({BREAK: 0}))
    waiting: list[np.ndarray] = field(default_factory=list)
    size: int = 0

    def add(self, words: list[bytes]) -> None:
        self.waiting.append(np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words)))
        self.size += len(words)

    def take(self, last: bool) -> tuple[np.ndarray, int, list[bytes]]:
        """Codes, the number of places that begin a phrase, the words; begins anew.

        The last places wait for what follows them, unless nothing does.
        """
        names = list(self.codes)
        codes = np.concatenate([*self.waiting, np.zeros(LONGEST if last else 0, np.int64)])
        begins = max(0, len(codes) - LONGEST)
        rest = [] if last else codes[begins:].tolist()
        self.codes, self.waiting, self.size = Codes({BREAK: 0}), [], 0
        if rest:
            self.add([names[c] for c in rest])
        return codes, begins, names


def joined(texts: list[bytes]) -> Iterator[bytes]:
    """Texts one after the other with breaks between them, about ``SLICE`` bytes at a time."""
    waiting, size = [], 0
    for text in texts:
        waiting.append(text)
        size += len(text)
        if size >= SLICE:
            yield BREAK.join(waiting)
            waiting, size = [], 0
    yield BREAK.join(waiting)


def gather(batches: Iterator[pa.RecordBatch], count) -> Iterator[pa.RecordBatch]:
    """Runs ``count(lang, codes, begins, names)`` over the words of (lang, text) rows."""
    by_lang: dict[str, Words] = {}

    def given(words: Words, last: bool) -> Iterator[pa.RecordBatch]:
        codes, begins, names = words.take(last)
        if begins:
            yield from count(words.lang, codes, begins, names)

    for batch in batches:
        table = pa.Table.from_batches([batch])
        for lang in pc.unique(table["lang"]).to_pylist():
            texts = table.filter(pc.equal(table["lang"], lang))["text"].cast(pa.binary()).to_pylist()
            words = by_lang.setdefault(lang, Words(lang))
            for text in joined(texts):
                for part in pieces_of(text):
                    words.add(part)
                    if words.size > GATHERED:
                        yield from given(words, last=False)
                words.add([BREAK])
        while sum(w.size for w in by_lang.values()) > 2 * GATHERED:
            yield from given(by_lang.pop(max(by_lang, key=lambda k: by_lang[k].size)), last=True)
    for words in by_lang.values():
        yield from given(words, last=True)


def texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), text_of(text_col).alias("text"))


def as_strings(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.binary()).cast(pa.string())


def word_counts(rows: DataFrame) -> DataFrame:
    """lang, word, n: all words of ``rows(lang, text)``."""

    def count(lang: str, codes: np.ndarray, begins: int, names: list[bytes]) -> Iterator[pa.RecordBatch]:
        n = np.bincount(codes[:begins], minlength=len(names))
        found = np.flatnonzero(n)
        found = found[found > 0]
        words = as_strings(names).take(pa.array(found))
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(found), pa.string()), words, pa.array(n[found])], names=["lang", "word", "n"]
        )

    found = rows.mapInArrow(lambda b: gather(b, count), "lang string, word string, n bigint")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- filters


def hashes_of(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh3_64_intdigest(lang)
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed=seed) for w in words), np.uint64, len(words))


def joint_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = (first * np.uint64(0x9E3779B97F4A7C15)) ^ ((second << np.uint64(31)) | (second >> np.uint64(33)))
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


class Bits:
    """A bit per hash, in the frame of one broadcast value."""

    def __init__(self, spark: SparkSession, bits: int, data: bytes):
        self.bits, self.shared = bits, spark.sparkContext.broadcast(data)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        data = np.frombuffer(self.shared.value, np.uint8)
        place = hashes >> np.uint64(64 - self.bits)
        return (data[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0

    def __getstate__(self):
        return {"bits": self.bits, "shared": self.shared}


def bits_of(found: DataFrame) -> Bits:
    """The filter of the phrases in ``found(lang, phrase)``, of any length."""
    spark = found.sparkSession
    bits = min(MOST_BITS, max(15, (32 * found.count()).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for lang in pc.unique(table["lang"]).to_pylist():
                own = table.filter(pc.equal(table["lang"], lang))["phrase"].cast(pa.binary()).to_pylist()
                of = reduce(joint_hash, (hashes_of(lang, list(words)) for words in zip(*(p.split(b" ") for p in own))))
                place = (of >> np.uint64(64 - bits)).astype(np.int64) + 1  # the functions count from 1
                yield pa.RecordBatch.from_arrays([pa.array(place)], names=["place"])

    placed = found.select("lang", "phrase").mapInArrow(places, "place bigint")
    blocks = placed.groupBy(F.bitmap_bucket_number("place").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap")
    )
    data = bytearray(2 ** (bits - 3))
    for row in blocks.toLocalIterator():
        at = (row["block"] - 1) * len(row["bitmap"])
        data[at : at + len(row["bitmap"])] = row["bitmap"]
    return Bits(spark, bits, bytes(data))


# ---------------------------------------------------------------- stripes


STRIPES = "lang string, first string, shard int, rests array<string>, counts array<bigint>"


def stripe_batch(
    lang: str, prefix: np.ndarray, following: np.ndarray, words: list[np.ndarray], names: pa.Array, own: np.ndarray, cut: np.ndarray
) -> pa.RecordBatch:
    """The stripes of occurrences: ``prefix`` by number, ``following`` by code.

    ``words`` has the codes of a prefix's words by its number. The stripes of all prefixes with one
    first word travel in one row, an entry as the text after that word; where the first word is to
    be ``cut`` there is a row per shard, ``own`` by the next word.
    """
    keys, counts = np.unique(prefix * len(names) + following, return_counts=True)
    owner, after = np.divmod(keys, len(names))
    first = words[0][owner]
    part = np.where(cut[first], own[after], 0)
    order = np.lexsort((part, first))
    owner, after, first, part, counts = owner[order], after[order], first[order], part[order], counts[order]
    starts = np.flatnonzero((np.diff(first, prepend=-1) != 0) | (np.diff(part, prepend=-1) != 0))
    offsets = pa.array(np.append(starts, len(owner)).astype(np.int32))
    rests = pc.binary_join_element_wise(*[names.take(pa.array(w)) for w in (*(w[owner] for w in words[1:]), after)], " ")
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * len(starts), pa.string()), names.take(pa.array(first[starts])),
            pa.array(part[starts].astype(np.int32)),
            pa.ListArray.from_arrays(offsets, rests), pa.ListArray.from_arrays(offsets, pa.array(counts)),
        ],
        names=["lang", "first", "shard", "rests", "counts"],
    )


def stripes(rows: DataFrame, held: list[Bits], hot: Bits) -> DataFrame:
    """Stripes of prefixes of ``len(held)`` words.

    ``held[k]`` tells which phrases of k + 1 words are frequent; an occurrence is looked at if those
    it begins and ends with are. ``hot`` holds the words whose stripes are cut.
    """

    def count(lang: str, codes: np.ndarray, begins: int, names: list[bytes]) -> Iterator[pa.RecordBatch]:
        hashes, text = hashes_of(lang, names), as_strings(names)
        own = (hashes % np.uint64(SHARDS)).astype(np.int64)
        # Of the phrases of n words: the number of that at each place, and whether it may be
        # frequent; by number its words and its hash.
        fine = held[0].holds(hashes)
        fine[0] = False
        number, fits, words, of = codes, fine[codes], [np.arange(len(names))], hashes
        for n, bits in enumerate(held[1:], 2):
            at = np.flatnonzero(fits[:-1] & fits[1:])
            keys, place = np.unique(number[at] * len(names) + codes[at + n - 1], return_inverse=True)
            left, right = np.divmod(keys, len(names))
            words, of = [*(w[left] for w in words), right], joint_hash(of[left], hashes[right])
            number, fits = np.zeros(len(codes), np.int64), np.zeros(len(codes), bool)
            number[at], fits[at] = place, bits.holds(of)[place]
        at = np.flatnonzero(fits[:begins] & fits[1 : begins + 1])
        if len(at):
            yield stripe_batch(lang, number[at], codes[at + len(held)], words, text, own, hot.holds(hashes))

    return rows.mapInArrow(lambda b: gather(b, count), STRIPES)


def merged(parts: DataFrame, least: int) -> DataFrame:
    """lang, phrase, a: stripes added up elementwise, their entries from ``least`` on.

    The stripes are dealt out by first word and shard; the sums keep to that.
    """
    keys = ["lang", "first", "shard"]
    entries = parts.repartition(*[F.col(k) for k in keys]).select(
        *keys, F.explode(F.arrays_zip("rests", "counts")).alias("e")
    )
    entries = entries.groupBy(*keys, F.col("e.rests").alias("rest")).agg(F.sum("e.counts").alias("a"))
    return entries.filter(F.col("a") >= least).select("lang", F.concat_ws(" ", "first", "rest").alias("phrase"), "a")


# ---------------------------------------------------------------- phrases


def scored(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """lang, phrase, l, r, score: the lowest-scoring cut of ``candidates(lang, phrase, a, length)``.

    ``known(lang, part, f)`` has the count of every part. A part may occur in many candidates.
    """
    cuts = candidates.select("lang", "phrase", "a", "length", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    sides = F.array(
        F.struct(F.lit(True).alias("head"), F.expr("substring_index(phrase, ' ', k)").alias("part")),
        F.struct(F.lit(False).alias("head"), F.expr("substring_index(phrase, ' ', k - length)").alias("part")),
    )
    parts = stored(cuts.select("lang", "phrase", "a", "k", F.inline(sides)))
    uses = parts.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("uses"))
    counts = stored(uses.join(known, ["lang", "part"]))
    found = join_counted(parts, counts, ["lang", "part"], "uses", parts.count(), F.col("phrase"))
    both = found.groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("head"), F.col("f"))).alias("l"), F.max(F.when(~F.col("head"), F.col("f"))).alias("r")
    )
    both = both.withColumn("above", F.lit(2_000_000).cast("decimal(18,0)") * F.col("a").cast("decimal(19,0)"))
    both = both.withColumn("below", F.col("l").cast("decimal(19,0)") + F.col("r").cast("decimal(19,0)"))
    best = both.withColumn("score", F.expr("above div below")).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best")
    )
    return best.select("lang", "phrase", "best.l", "best.r", "best.score")


def collocations(
    docs: DataFrame,
    least: int = 30,
    inside: int = 80,
    top: int | None = 2000,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the first ``top`` phrases of each language.

    ``least`` is the count a phrase must have; one that lies in a longer frequent phrase with
    ``inside`` or more percent of its count is left out. With ``top`` null, all are returned.
    """
    rows = texts(docs, lang_col, text_col)
    words = stored(word_counts(rows))
    single = words.filter(F.col("n") >= least)
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = bits_of(words.filter(F.col("n") > part_rows(docs.sparkSession, total)).select("lang", F.col("word").alias("phrase")))
    found, held = [single.select("lang", F.col("word").alias("phrase"), F.col("n").alias("a"), F.lit(1).alias("length"))], []
    for length in range(2, LONGEST + 1):
        held.append(bits_of(found[-1]))
        found.append(stored(merged(stripes(rows, held, hot), least).withColumn("length", F.lit(length))))

    longer = reduce(DataFrame.union, found[1:])
    around = longer.filter("length > 2")
    covers = around.select("lang", F.expr("substring_index(phrase, ' ', length - 1)").alias("phrase"), "a").union(
        around.select("lang", F.expr("substr(phrase, instr(phrase, ' ') + 1)").alias("phrase"), "a")
    )
    covers = covers.groupBy("lang", "phrase").agg(F.max("a").alias("covered"))
    hundred = lambda c, by: F.col(c).cast("decimal(38,0)") * F.lit(by)
    open_ = F.col("covered").isNull() | (hundred("covered", 100) < hundred("a", inside))
    candidates = stored(longer.join(covers, ["lang", "phrase"], "left").filter(open_).select("lang", "phrase", "a", "length"))

    totals = reduce(DataFrame.union, found[:-1]).select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    best = scored(candidates, totals)
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    found = candidates.drop("length").join(best, ["lang", "phrase"])
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    if top is not None:
        # The best of each part of a language first, so that no task orders a whole language.
        part = F.pmod(F.xxhash64("phrase"), F.lit(64))
        at = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
        found = found.withColumn("part", part).withColumn("at", at).filter(F.col("at") <= top).drop("part", "at")
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    if top is not None:
        found = found.filter(F.col("rank") <= top)
    return found.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
