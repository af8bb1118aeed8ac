"""Joins and ordered windows that hold when one key has a large share of the rows.

A hot key is one with more than ``rows`` rows. There are at most N / rows of them, so the
list of hot keys is small enough to broadcast (one million at 5e12 rows). It comes from one
partial aggregate over the key columns alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pagetide.sources.tables import stored_with

HOT_ROWS = 5_000_000
SLOT_MINUTES = 5


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``rows`` rows and the number of parts each is to be cut into."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > rows)
        .select(*keys, F.ceil(F.col("_n") / F.lit(float(rows))).cast("int").alias("_parts"))
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    hot: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """Equi join with the rows of the ``hot`` keys (keys, ``_parts``) cut into parts.

    ``right`` is repeated once per part for those keys. It may bring its own ``_parts``
    column; otherwise it is looked up in ``hot``.
    """
    keys = list(keys)
    parts = F.coalesce("_parts", F.lit(1))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    # Rows with a null key match nothing, so they may go anywhere: to as many parts as the
    # hash has values.
    place = F.xxhash64(*(spread or left.columns))
    salt = F.when(no_key, (place % F.lit(2**31 - 1)).cast("int")).otherwise(
        F.when(parts > 1, F.pmod(place, parts.cast("bigint")).cast("int")).otherwise(F.lit(0))
    )
    salted = left.join(F.broadcast(hot), keys, "left").select(*left.columns, salt.alias("_salt"))
    known = right if "_parts" in right.columns else right.join(F.broadcast(hot), keys, "left")
    repeated = known.select(
        *[c for c in right.columns if c != "_parts"],
        F.explode(F.sequence(F.lit(0), parts - 1)).alias("_salt"),
    )
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    spread: Sequence[str] | None = None,
    rows: int = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi join on ``keys`` with the hot keys of the left side salted.

    ``right`` must be the side with few rows per key: its rows for a hot key are repeated
    once per part. ``spread`` names the left columns that place a row in a part (default:
    all). ``how`` is inner, left, left_semi or left_anti. Which side is broadcast, if any,
    is left to Catalyst's own size check. Pass ``hot`` where the left side is itself the
    result of joins, counted on the table it comes from, so that those are not run again.
    """
    hot = hot_keys(left, keys, rows) if hot is None else hot
    return salted_join(left, right, hot, keys, how, spread)


def parts_of(count: Column | str, rows: int = HOT_ROWS) -> Column:
    """Number of parts for a key with ``count`` rows; NULL unless it is hot."""
    n = F.col(count) if isinstance(count, str) else count
    return F.when(n > rows, F.ceil(n / F.lit(float(rows))).cast("int"))


def time_slot(ts: Column | str) -> Column:
    """Number of the five-minute slot of a zone-free timestamp."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    per_hour = 60 // SLOT_MINUTES
    return (
        F.unix_date(F.to_date(ts)).cast("bigint") * (24 * per_hour)
        + F.hour(ts) * per_hour
        + F.floor(F.minute(ts) / SLOT_MINUTES)
    ).cast("bigint")


def number_versions(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    ties: Sequence[str],
    number: str = "version",
    following: str | None = None,
    rows: int = HOT_ROWS,
) -> DataFrame:
    """``row_number()`` and ``lead(ts)`` per key in the order of ``ts`` and ``ties``, null times first.

    The input is stored once and counted as it is written; if it is large, its keys are counted
    there. Without a hot key the result is one window. Otherwise a hot key is cut into time slots; each
    slot is numbered by itself and takes the row count of the slots before it and the first
    time of the slot after it from a table with one row per slot. Rows of one time share a
    slot: a key with more than ``rows`` of those is beyond this cut.
    """
    keys = list(keys)
    df, seen = stored_with(df, n=F.count(F.lit(1)))

    def plain(part: DataFrame) -> DataFrame:
        by_key = Window.partitionBy(*keys).orderBy(ts, *ties)
        out = part.withColumn(number, F.row_number().over(by_key).cast("bigint"))
        return out.withColumn(following, F.lead(ts).over(by_key)) if following else out

    # With no more rows than that in all, no key has more.
    if seen["n"] <= rows:
        return plain(df)
    hot, seen = stored_with(hot_keys(df, keys, rows), n=F.count(F.lit(1)))
    if not seen["n"]:
        return plain(df)
    marked = df.join(F.broadcast(hot), keys, "left")
    cold = plain(marked.filter("_parts is null").drop("_parts"))
    # Rows without a time come first, in a slot of their own.
    slot = F.struct(F.col(ts).isNotNull().alias("known"), time_slot(ts).alias("slot"))
    slotted = marked.filter("_parts is not null").drop("_parts").withColumn("_slot", slot)
    by_slot = Window.partitionBy(*keys).orderBy("_slot")
    carry = (
        slotted.groupBy(*keys, "_slot")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min(ts).alias("_first"))
        .select(
            *keys,
            "_slot",
            F.sum("_rows").over(by_slot.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
            F.lead("_first").over(by_slot).alias("_after"),
        )
    )
    within = Window.partitionBy(*keys, "_slot").orderBy(ts, *ties)
    numbered = (
        slotted.withColumn(number, F.row_number().over(within).cast("bigint"))
        .withColumn("_next", F.lead(ts).over(within))
        .alias("l")
    )
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"c.{k}")) for k in [*keys, "_slot"]]
    joined = numbered.join(carry.alias("c"), same).select(
        *[F.col(f"l.{c}").alias(c) for c in df.columns],
        (F.col(f"l.{number}") + F.coalesce("_before", F.lit(0))).alias(number),
        *([F.coalesce("_next", "_after").alias(following)] if following else []),
    )
    return cold.unionByName(joined)


def running_max(
    df: DataFrame,
    part: Sequence[str],
    pos: str,
    value: Column,
    out: str,
    inclusive: bool = True,
    bits: int = 21,
) -> DataFrame:
    """Add ``out``, the running maximum of ``value`` by the whole number ``pos`` per ``part``.

    Equal positions are peers, as under a RANGE frame. A part is cut into blocks of 2**bits
    positions. Each block is scanned by itself and takes the maximum of the earlier blocks
    from a table with one row per block, so no task holds a whole part. Choose ``bits`` so
    that both a block and the list of blocks of a part fit a task. ``value`` may be any
    orderable type, structs included.
    """
    return running_extremes(df, part, pos, {out: value}, {}, inclusive, bits)


def running_extremes(
    df: DataFrame,
    part: Sequence[str],
    pos: str,
    highs: Mapping[str, Column],
    lows: Mapping[str, Column],
    inclusive: bool = True,
    bits: int = 21,
) -> DataFrame:
    """``running_max`` of several values, and the running minimum of others, in one scan."""
    part = list(part)
    kinds = [(out, value, F.max, F.greatest) for out, value in highs.items()]
    kinds += [(out, value, F.min, F.least) for out, value in lows.items()]
    blocked = df.withColumns({f"_v{i}": value for i, (_, value, _, _) in enumerate(kinds)})
    blocked = blocked.withColumn("_block", F.shiftright(pos, bits))
    before = Window.partitionBy(*part).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        blocked.groupBy(*part, "_block")
        .agg(*[best(f"_v{i}").alias(f"_m{i}") for i, (_, _, best, _) in enumerate(kinds)])
        .select(*part, "_block", *[best(f"_m{i}").over(before).alias(f"_m{i}") for i, (_, _, best, _) in enumerate(kinds)])
    )
    within = (
        Window.partitionBy(*part, "_block")
        .orderBy(pos)
        .rangeBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    return (
        blocked.withColumns({f"_v{i}": best(f"_v{i}").over(within) for i, (_, _, best, _) in enumerate(kinds)})
        .join(carry, [*part, "_block"])
        .select(*df.columns, *[better(f"_v{i}", f"_m{i}").alias(out) for i, (out, _, _, better) in enumerate(kinds)])
    )


def following(
    df: DataFrame,
    part: Sequence[str],
    pos: str,
    order: Sequence[str],
    value: str,
    out: str,
    bits: int = 21,
) -> DataFrame:
    """Add ``out``, ``lead(value)`` per ``part`` in an order that starts with ``pos``.

    Cut into blocks as in ``running_max``; the last row of a block is followed by the first
    row of the next block, taken from a table with one row per block. ``value`` must not be
    null.
    """
    part, order = list(part), list(order)
    blocked = df.withColumn("_block", F.shiftright(pos, bits))
    firsts = (
        blocked.groupBy(*part, "_block")
        .agg(F.min_by(value, F.struct(pos, *order)).alias("_first"))
        .select(
            *part,
            "_block",
            F.lead("_first").over(Window.partitionBy(*part).orderBy("_block")).alias("_after"),
        )
    )
    within = Window.partitionBy(*part, "_block").orderBy(pos, *order)
    return (
        blocked.withColumn("_next", F.lead(value).over(within))
        .join(firsts, [*part, "_block"])
        .select(*df.columns, F.coalesce("_next", "_after").alias(out))
    )
