"""Packing of token sequences into training sequences of a fixed length.

Documents are encoded and cut into pieces of 1 to ``capacity`` tokens (``pieces``). What the
packing of pieces can look like depends on their lengths alone, so it is decided on the
histogram of lengths, which has at most ``capacity`` rows whatever the input (``plan``):

1. Reduction by dominance (Martello and Toth): for the longest open length, if some set of
   at most three pieces that holds it is at least as good as any other, sequences of that
   form are fixed for as many pieces as there are, and the instance shrinks.
2. What the reduction cannot decide is packed by best fit, longest first, with equal
   sequences kept as one entry and a count.

The plan is a list of runs: pieces number s to s + n of a length go to these sequences at
this offset. Its size has a bound that does not depend on the input (see ``plan``), so it may
be broadcast. Pieces get their number within their length on Spark, with frequent
lengths cut into parts, and find their run (``assign``).

Defined cases: a null text is an empty one and still has its end token; an empty table gives
an empty result; repeated rows are packed as often as they occur.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from pagetide.llm.common import part_rows, text_of
from pagetide.sources.tables import stored

#: Column of a random number from 0 to 1, by which rows of one length are divided.
SPREAD = "_spread"
CAPACITY = 2048


# --- encoding


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins for bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_encoding(path: str):
    """Encoder for a byte-level BPE vocabulary file, special strings in a text included."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte = byte_symbols()
    ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    for token in special:
        ranks.pop(token.encode(), None)
    return tiktoken.Encoding(
        "byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
    )


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens; only the first may be short."""
    if n <= capacity:
        return [n]
    first = n % capacity
    return ([first] if first else []) + [capacity] * (n // capacity)


def pieces(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = 0,
    slice_rows: int = 256,
) -> DataFrame:
    """id, piece, start, length and the ids as little-endian unsigned 32-bit numbers."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoding(tokenizer)
        special = set(encoder.special_tokens_set)
        for whole in batches:
            for at in range(0, whole.num_rows, slice_rows):  # ids take more room than texts
                batch = whole.slice(at, slice_rows)
                out: list[tuple] = []
                for row, text in enumerate(batch.column("text").to_pylist()):
                    ids = np.append(
                        encoder.encode_to_numpy(text, allowed_special=special, disallowed_special=()), end_id
                    ).astype("<u4")
                    lengths = cut_lengths(len(ids), capacity)
                    for k, (n, end) in enumerate(zip(lengths, accumulate(lengths))):
                        out.append((row, k, end - n, n, ids[end - n : end].tobytes()))
                rows, k, start, length, data = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(rows)), pa.array(k, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(data, pa.binary()),
                    ],
                    names=["id", "piece", "start", "length", "ids"],
                )

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(encode, f"id {id_type}, piece int, start bigint, length bigint, ids binary")


# --- the plan


class Lengths:
    """Counts of open pieces by length."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.n = np.zeros(capacity + 1, np.int64)
        for length, count in counts.items():
            self.n[length] = count

    def at_most(self, length: int, without: tuple[int, ...] = ()) -> int:
        """The longest open length up to ``length``, the pieces ``without`` taken; 0 if none."""
        for k in np.flatnonzero(self.n[: max(length, 0) + 1])[::-1]:
            if self.n[k] > without.count(k):
                return int(k)
        return 0

    def shortest(self, count: int, without: tuple[int, ...] = ()) -> list[int]:
        """The ``count`` shortest open pieces."""
        out: list[int] = []
        for k in map(int, np.flatnonzero(self.n)):
            free = int(self.n[k]) - without.count(k)
            out += [k] * min(max(free, 0), count - len(out))
            if len(out) == count:
                break
        return out

    def take(self, form: tuple[int, ...]) -> int:
        """As many pieces as sequences of this form use up; returns the number of sequences."""
        times = min(int(self.n[k]) // form.count(k) for k in set(form))
        for k in form:
            self.n[k] -= times
        return times


def dominating(open_: Lengths, longest: int, capacity: int) -> tuple[int, ...] | None:
    """A set of at most three pieces with ``longest`` that no other set with it can beat.

    A set beats another if the other's pieces can be dealt out among its pieces without
    exceeding them. What may stand beside ``longest`` has at most ``room`` tokens.
    """
    room = capacity - longest
    mine = (longest,)
    small = open_.shortest(3, mine)
    if not small or small[0] > room:
        return mine
    one = open_.at_most(room, mine)
    if one == room:  # a single piece fills the room: anything else fits into that piece
        return (longest, one)
    if len(small) < 2 or small[0] + small[1] > room:  # only single pieces fit: the longest one
        return (longest, one)
    if len(small) == 3 and sum(small) <= room:
        return None
    # One or two pieces fit. Take the longest that fits and the longest beside it: any pair
    # (p, q) with q no longer than the second is dealt out one by one; a pair with both
    # longer than the second must fit into the first together.
    two = open_.at_most(room - one, (longest, one))
    if not two:
        return None
    high = [k for k in np.flatnonzero(open_.n[: room - two]).tolist() if k > two]
    for k in high:
        other = open_.at_most(room - k, (longest, k))
        if other > two and k + other > one:
            return None
    return (longest, one, two)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[tuple[int, ...], int]], int]:
    """Forms of sequences and how many of each; and how many of them the reduction fixed.

    Size: a step of the reduction uses up a length, or all but one piece of it, hence there
    are at most 2 * capacity such forms. Best fit adds at most four entries per length: parts
    of the one it fills last, and new ones; entries it fills whole stay one entry. A form has
    fewer than 65 different lengths of up to 2048 tokens in total, and a run is kept per
    different length, hence at most 6 * 2048 * 64 runs of 48 bytes for the default capacity,
    38 MB; a few thousand in practice.
    """
    open_ = Lengths(counts, capacity)
    fixed: list[tuple[tuple[int, ...], int]] = []
    for longest in range(capacity, 0, -1):
        # What is undecided stays open, so that shorter pieces are judged with it in view.
        while open_.n[longest] and (form := dominating(open_, longest, capacity)):
            fixed.append((form, open_.take(form)))
    rest = {k: int(open_.n[k]) for k in map(int, np.flatnonzero(open_.n))}
    return fixed + best_fit(rest, capacity), sum(n for _, n in fixed)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, over counts. Entries are equal sequences with a count."""
    by_free: dict[int, list[list]] = {}  # free space -> [form, number]
    for length in sorted(counts, reverse=True):
        n = counts[length]
        for free in sorted(f for f in by_free if f >= length):
            if not n:
                break
            for entry in by_free.pop(free):
                form, number = entry
                each = free // length
                full = min(number, n // each)
                if full:
                    by_free.setdefault(free - each * length, []).append([form + (length,) * each, full])
                    n -= full * each
                if full < number:
                    rest = number - full
                    if n and n < each:
                        by_free.setdefault(free - n * length, []).append([form + (length,) * n, 1])
                        rest, n = rest - 1, 0
                    if rest:
                        by_free.setdefault(free, []).append([form, rest])
        each = capacity // length
        if n // each:
            by_free.setdefault(capacity - each * length, []).append([(length,) * each, n // each])
        if n % each:
            by_free.setdefault(capacity - n % each * length, []).append([(length,) * (n % each), 1])
    return [(form, number) for entries in by_free.values() for form, number in entries]


def runs(forms: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first piece, pieces, pieces per sequence, first sequence, offset)."""
    out, used, sequence = [], {}, 0
    for form, number in forms:
        offset, k = 0, 0
        while k < len(form):
            each = 1
            while k + each < len(form) and form[k + each] == form[k]:
                each += 1
            first = used.get(form[k], 0)
            out.append((form[k], first, number * each, each, sequence, offset))
            used[form[k]] = first + number * each
            offset += each * form[k]
            k += each
        sequence += number
    return out


def assign(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces (id, piece, start, length, SPREAD, more columns) with sequence_id and offset.

    ``parts`` is read several times: give a stored table, in which SPREAD is fixed.
    """
    spark = parts.sparkSession
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    forms, _ = plan(counts, capacity)
    table = np.array(runs(forms), np.int64).reshape(-1, 6)
    shared = spark.sparkContext.broadcast(table[np.lexsort((table[:, 1], table[:, 0]))])

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        table, shift = shared.value, 48
        # The run of a piece is the last that starts at or before its number.
        at = np.searchsorted((table[:, 0] << shift) + table[:, 1], (length.to_numpy() << shift) + number, "right") - 1
        run = table[at]
        k = number.to_numpy() - run[:, 1]
        return pd.DataFrame(
            {"sequence_id": run[:, 4] + k // run[:, 3], "offset": run[:, 5] + k % run[:, 3] * run[:, 0]}
        )

    numbered = _numbered(parts, part_rows(spark, sum(counts.values())))
    return numbered.withColumn("to", place("length", "number")).select(
        *parts.columns, F.col("to.sequence_id").alias("sequence_id"), F.col("to.offset").alias("offset")
    )


def _numbered(parts: DataFrame, rows: int) -> DataFrame:
    """``number`` of each piece among those of its length, from 0.

    A frequent length is cut into parts by ``SPREAD``, a stored random number of the row that
    rows without ids and repeated rows differ in too; a part is numbered by itself and starts
    after the rows of the parts before it.
    """
    sizes = parts.groupBy("length").agg(F.ceil(F.count(F.lit(1)) / F.lit(rows)).alias("_parts"))
    # At most ``capacity`` rows, one per length.
    placed = parts.join(F.broadcast(sizes), "length").withColumn(
        "_part", F.floor(F.col(SPREAD) * F.col("_parts")).cast("int")
    )
    # At most capacity + 8 * shuffle partitions rows.
    before = placed.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "length", "_part",
        (F.sum("_n").over(Window.partitionBy("length").orderBy("_part")) - F.col("_n")).alias("_before"),
    )
    within = Window.partitionBy("length", "_part").orderBy(SPREAD, "id", "piece", "start")
    return (
        placed.withColumn("_row", F.row_number().over(within))
        .join(F.broadcast(before), ["length", "_part"])
        .withColumn("number", F.col("_row") - 1 + F.col("_before"))
        .select(*parts.columns, "number")
    )


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces, stored once, with their places."""
    return assign(stored(parts.withColumn(SPREAD, F.rand(7))), capacity).drop(SPREAD)


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id and its ids, for pieces that still have theirs; at most ``capacity`` each."""
    return placed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    ).select("sequence_id", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
