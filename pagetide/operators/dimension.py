"""The item dimension: type 2 versions per (author, item), and an append-only history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from pagetide.functions.scalars import as_ts, owner_key, run_stamp, ts_lit, wall_clock
from pagetide.operators.load import append, restrict_to_batch_keys
from pagetide.plans.skew import HOT_ROWS, number_versions, skew_join, time_slot

KEY = ["author_id", "media_id"]
PAYLOAD = ["media_duration", "media_blob"]
RETAIN_RUNS = 5


def message_item_rows(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """author_id, media_id, media_duration, media_blob, valid_from_ts; expired rows count."""
    return (
        messages.select(
            *keep,
            owner_key(messages, "fromUser").alias("author_id"),
            as_ts(messages, "createdAt").alias("valid_from_ts"),
            F.explode("media").alias("_item"),
        )
        .filter(F.col("author_id").isNotNull() & F.col("valid_from_ts").isNotNull())
        .select(
            *keep,
            "author_id",
            F.col("_item.id").cast("bigint").alias("media_id"),
            F.col("_item.duration").cast("bigint").alias("media_duration"),
            F.to_json("_item").alias("media_blob"),
            "valid_from_ts",
        )
    )


def _as_new(items: DataFrame, run_ts: datetime, keep: Sequence[str] = ()) -> DataFrame:
    """Distinct items as open first versions of a run."""
    return items.distinct().select(
        *KEY,
        *PAYLOAD,
        F.lit(1).alias("seen_count"),
        "valid_from_ts",
        F.lit(None).cast("timestamp_ntz").alias("valid_to_ts"),
        F.lit(True).alias("is_current"),
        wall_clock(run_stamp(ts_lit(run_ts))).alias("extract_ts"),
        *keep,
    )


def item_versions(messages: DataFrame, run_ts: datetime, keep: Sequence[str] = ()) -> DataFrame:
    """The items of message rows as new versions, with the columns ``keep`` of their rows."""
    return _as_new(message_item_rows(messages, keep), run_ts, keep)


def dim_increment(
    messages: DataFrame, dim: DataFrame, run_ts: datetime, include_gaps: bool = False
) -> DataFrame:
    """New versions for the dimension: items strictly outside their author's known range.

    Rows dated more than a day after the run are left out. Late rows that fall inside the
    range are left out too, unless ``include_gaps`` asks for every version not yet known.
    """
    rows = messages.filter(as_ts(messages, "createdAt") <= ts_lit(run_ts) + F.expr("INTERVAL '1' DAY"))
    if include_gaps:
        items = message_item_rows(rows).distinct()
        known = dim.select(*KEY, "valid_from_ts").distinct()
        return _as_new(items.join(known, [*KEY, "valid_from_ts"], "left_anti"), run_ts)
    bounds = dim.groupBy("author_id").agg(
        F.min("valid_from_ts").alias("_low"), F.max("valid_from_ts").alias("_high")
    )
    keyed = rows.withColumn("author_id", owner_key(messages, "fromUser")).withColumn(
        "_ts", as_ts(messages, "createdAt")
    )
    ranged = skew_join(keyed, bounds, ["author_id"], "left", spread=["id"])
    outside = F.col("_low").isNull() | (F.col("_ts") < F.col("_low")) | (F.col("_ts") > F.col("_high"))
    return item_versions(ranged.filter(outside).select(*messages.columns), run_ts)


def src_distinct(increment: DataFrame) -> DataFrame:
    return increment.distinct()


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


DIM_COLUMNS = [
    *KEY, *PAYLOAD, "seen_count", "valid_from_ts", "valid_to_ts", "is_current", "extract_ts"
]
BASE = [*KEY, *PAYLOAD, "valid_from_ts", "extract_ts"]
TIES = ["extract_ts", "media_blob", "media_duration"]


def versioned(rows: DataFrame, rows_per_task: int = HOT_ROWS, by: Sequence[str] = ()) -> DataFrame:
    """Number the versions of each key by time and close each at the start of the next.

    Equal times are ordered by run, then by payload, NULLs first. ``by`` adds columns to the
    key that are not returned.
    """
    return _shown(
        number_versions(
            rows, [*KEY, *by], "valid_from_ts", TIES, number="seen_count", following="valid_to_ts", rows=rows_per_task
        )
    )


def numbered(rows: DataFrame) -> DataFrame:
    """``versioned`` where no key is hot: one window, which keeps the place of the rows."""
    by_key = Window.partitionBy(*KEY).orderBy("valid_from_ts", *TIES)
    return _shown(
        rows.withColumn("seen_count", F.row_number().over(by_key)).withColumn(
            "valid_to_ts", F.lead("valid_from_ts").over(by_key)
        )
    )


def _shown(rows: DataFrame) -> DataFrame:
    return rows.select(
        *KEY,
        *PAYLOAD,
        F.col("seen_count").cast("int").alias("seen_count"),
        "valid_from_ts",
        "valid_to_ts",
        F.col("valid_to_ts").isNull().alias("is_current"),
        "extract_ts",
    )


def _touched(dim: DataFrame, increment: DataFrame, rows: int) -> DataFrame:
    """Dimension rows with ``_touched`` set for the increment's keys."""
    keys = increment.select(*KEY).distinct().withColumn("_touched", F.lit(True))
    return skew_join(dim, keys, KEY, "left", spread=["valid_from_ts", "extract_ts"], rows=rows)


def rebuilt_versions(dim: DataFrame, increment: DataFrame, rows: int = HOT_ROWS) -> DataFrame:
    """All versions, old and new, of the keys in the increment."""
    old = restrict_to_batch_keys(dim.select(*BASE), increment, KEY)
    return versioned(union_distinct(old, increment.select(*BASE)), rows)


def scd2_rebuild(dim: DataFrame, increment: DataFrame, rows: int = HOT_ROWS) -> DataFrame:
    """Dimension with the increment's keys rebuilt and all other keys as they were.

    Give stored tables: the inputs are read twice.
    """
    flagged = _touched(dim, increment, rows)
    both = union_distinct(flagged.filter("_touched").select(*BASE), increment.select(*BASE))
    rest = flagged.filter(F.col("_touched").isNull()).select(*dim.columns)
    return append(rest, versioned(both, rows))


def versions_by_page(dim: DataFrame, increment: DataFrame, rows: int = HOT_ROWS) -> DataFrame:
    """What a page-by-page run adds to the history: after each page, all versions of its keys.

    ``increment`` has the page that brought each version in ``batch_seq``.
    """
    pages = increment.select(*KEY, F.col("batch_seq").alias("_page")).distinct()
    old = restrict_to_batch_keys(dim.select(*BASE), increment, KEY)
    known = old.withColumn("batch_seq", F.lit(-1).cast("bigint")).unionByName(increment.select(*BASE, "batch_seq"))
    by_then = known.join(pages, KEY).filter(F.col("batch_seq") <= F.col("_page"))
    return versioned(by_then.select(*BASE, "_page").distinct(), rows, by=["_page"])


def history_append(history: DataFrame, dim: DataFrame, increment: DataFrame) -> DataFrame:
    """History plus the dimension's rows for the keys of the batch."""
    return append(history, restrict_to_batch_keys(dim, increment, KEY))


def last_n_runs(history: DataFrame, n: int) -> DataFrame:
    """Newest ``n`` distinct run stamps."""
    return (
        history.select("extract_ts")
        .distinct()
        .orderBy(F.col("extract_ts").desc_nulls_last())
        .limit(n)
    )


def history_prune(history: DataFrame, n: int | None = RETAIN_RUNS) -> DataFrame:
    """History of the newest ``n`` runs; rows without a stamp always stay.

    The stamps kept are at least the n-th newest, so one value, found by a top-n over the
    distinct stamps, decides for every row.
    """
    n = n if n is not None and n >= 1 else RETAIN_RUNS
    stamped = history.filter(F.col("extract_ts").isNotNull())
    oldest = last_n_runs(stamped, n).agg(F.min("extract_ts").alias("_oldest"))
    kept = history.withColumn("_one", F.lit(1)).join(
        F.broadcast(oldest.withColumn("_one", F.lit(1))), "_one"
    )
    return kept.filter(
        F.col("extract_ts").isNull() | (F.col("extract_ts") >= F.col("_oldest"))
    ).select(*history.columns)


def ordered_dim_listing(dim: DataFrame, first_seen: bool = True) -> DataFrame:
    """Videos seen for the first time, or the re-seen and closed versions, in key order."""
    rows = dim.filter(F.col("media_duration") > 0)
    again = (F.col("seen_count") > 1) | ~F.col("is_current")
    rows = rows.filter((F.col("seen_count") == 1) if first_seen else again)
    return rows.select(
        *KEY, "seen_count", "media_duration", "valid_from_ts", "valid_to_ts", "is_current"
    ).orderBy(*KEY, "valid_from_ts", "seen_count")


def legacy_last_value(dim: DataFrame) -> DataFrame:
    """Start that closed a version in the retired merge.

    It was the last value over (key, newest first) up to the current row, whose peers share
    their start, so it is the row's own start and needs no window.
    """
    return dim.select(*KEY, "valid_from_ts", F.col("valid_from_ts").alias("last_from_ts"))


# -- links between items and messages ----------------------------------------------------


def item_message_link(messages: DataFrame, run_ts: datetime) -> DataFrame:
    """One row per (author, item, message), open while the message is active."""
    linked = (
        messages.select(
            owner_key(messages, "fromUser").alias("author_id"),
            F.col("id").alias("chat_id"),
            as_ts(messages, "createdAt").alias("valid_from_ts"),
            F.col("expired_ts").alias("valid_to_ts"),
            F.explode(F.array_distinct("media.id")).alias("media_id"),
        )
        .filter(F.col("author_id").isNotNull())
        .groupBy(*KEY, "chat_id")
        # A message stored twice gives one link, open if any copy is active.
        .agg(
            F.min("valid_from_ts").alias("valid_from_ts"),
            F.when(F.count_if(F.col("valid_to_ts").isNull()) == 0, F.max("valid_to_ts")).alias(
                "valid_to_ts"
            ),
        )
    )
    return linked.select(
        "author_id",
        "media_id",
        "chat_id",
        "valid_from_ts",
        "valid_to_ts",
        F.col("valid_to_ts").isNull().alias("is_current"),
        wall_clock(run_stamp(ts_lit(run_ts))).alias("extract_ts"),
    )


def overlap_join(links: DataFrame, as_of: datetime) -> DataFrame:
    """Per link, the earlier links of its item that are still open when it starts.

    Earlier is by start, then message; open links end at ``as_of``, and a link covers its
    start, not its end. Gives ``n_open``, their number, and ``overlaps``. One row per link
    comes out, however many an item has: the pairs, their square, are not listed.

    Starts and ends of an item's links stand on one line, a start counting one up and an end
    one down; the sum before a start is what is open there. The line is cut into time slots,
    each summed by itself, so no task holds an item.
    """
    spans = links.filter("valid_from_ts is not null").select(
        *KEY, "chat_id", "valid_from_ts", F.coalesce("valid_to_ts", ts_lit(as_of)).alias("_end")
    )
    covers = F.col("_end") > F.col("valid_from_ts")

    def event(at: str, kind: int, step: Column) -> Column:
        return F.struct(F.col(at).alias("at"), F.lit(kind).alias("kind"), step.alias("step"))

    start = event("valid_from_ts", 1, F.when(covers, 1).otherwise(0))
    end = F.when(covers, event("_end", 0, F.lit(-1)))
    line = spans.select(*KEY, "chat_id", F.explode(F.array(start, end)).alias("_e")).filter("_e is not null")
    line = line.select(*KEY, "chat_id", "_e.*").withColumn("_slot", time_slot("at"))
    before = Window.partitionBy(*KEY).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = line.groupBy(*KEY, "_slot").agg(F.sum("step").alias("_sum"))
    slots = slots.select(*KEY, "_slot", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    within = (
        Window.partitionBy(*KEY, "_slot").orderBy("at", "kind", "chat_id").rowsBetween(Window.unboundedPreceding, -1)
    )
    opened = line.withColumn("_sum", F.coalesce(F.sum("step").over(within), F.lit(0))).filter("kind = 1")
    n_open = F.col("_sum") + F.col("_before")
    return opened.join(slots, [*KEY, "_slot"]).select(
        *KEY, "chat_id", n_open.alias("n_open"), (n_open > 0).alias("overlaps")
    )


# -- delete-aware dimension --------------------------------------------------------------


def checksum(*cols: str) -> Column:
    """MD5 of the values as JSON."""
    return F.md5(F.to_json(F.struct(*cols)))


def dim_delete_aware(dim: DataFrame, messages: DataFrame) -> DataFrame:
    """Dimension with ``is_deleted`` and ``checksum``.

    A key is deleted when no active message holds the item any more, and comes back when one
    does. Closed versions keep their place in time and are never marked.
    """
    alive = (
        messages.filter(F.col("expired_ts").isNull())
        .select(
            owner_key(messages, "fromUser").alias("author_id"),
            F.explode(F.col("media.id").cast("array<bigint>")).alias("media_id"),
        )
        .distinct()
        .withColumn("_alive", F.lit(True))
    )
    return skew_join(dim, alive, KEY, "left").select(
        *dim.columns,
        (F.col("is_current") & F.col("_alive").isNull()).alias("is_deleted"),
        checksum("media_duration", "media_blob").alias("checksum"),
    )


def checksum_change(old: DataFrame, new: DataFrame) -> DataFrame:
    """Current versions whose payload differs between two delete-aware dimensions."""
    before = old.filter("is_current").select(*KEY, F.col("checksum").alias("old_checksum"))
    after = new.filter("is_current").select(*KEY, F.col("checksum").alias("new_checksum"))
    return before.join(after, KEY).filter(F.col("old_checksum") != F.col("new_checksum"))


# -- retired merge -----------------------------------------------------------------------


def scd2_merge_legacy(dim: DataFrame, source: DataFrame) -> DataFrame:
    """Retired merge of one new version per key, kept for comparison.

    Matched rows: a newer source closes the current row, an older or equal one raises its
    ``seen_count``. If the merge inserted no new key at all, each matched source row is
    added as a version of its own, next to the newest row of its key. It mishandles
    backfills; ``scd2_rebuild`` replaces it.
    """
    src = source.select(
        *KEY, F.col("media_duration").alias("_d"), F.col("media_blob").alias("_b"),
        F.col("valid_from_ts").alias("_from"), F.col("extract_ts").alias("_x"),
    )
    matched = skew_join(dim, src, KEY, "left")
    newer = (F.col("_from") > F.col("valid_from_ts")) & F.col("is_current")
    older = F.col("_from") <= F.col("valid_from_ts")
    merged = matched.select(
        *KEY,
        *PAYLOAD,
        F.when(older, F.col("seen_count") + 1).otherwise(F.col("seen_count")).alias("seen_count"),
        "valid_from_ts",
        F.when(newer, F.col("_from")).otherwise(F.col("valid_to_ts")).alias("valid_to_ts"),
        F.when(newer, F.lit(False)).otherwise(F.col("is_current")).alias("is_current"),
        "extract_ts",
    )
    fresh = src.join(dim.select(*KEY).distinct(), KEY, "left_anti")
    inserted = fresh.select(
        *KEY, F.col("_d").alias("media_duration"), F.col("_b").alias("media_blob"),
        F.lit(1).alias("seen_count"), F.col("_from").alias("valid_from_ts"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to_ts"), F.lit(True).alias("is_current"),
        F.col("_x").alias("extract_ts"),
    )
    newest = merged.groupBy(*KEY).agg(
        F.max(F.struct("valid_from_ts", "seen_count")).alias("_last")
    )
    after = F.col("_from") > F.col("_last.valid_from_ts")
    added = src.join(newest, KEY).select(
        *KEY,
        F.col("_d").alias("media_duration"),
        F.col("_b").alias("media_blob"),
        F.when(after, F.col("_last.seen_count") + 1).otherwise(F.lit(1)).alias("seen_count"),
        F.col("_from").alias("valid_from_ts"),
        F.when(after, F.lit(None)).otherwise(F.col("_last.valid_from_ts")).cast("timestamp_ntz").alias(
            "valid_to_ts"
        ),
        after.alias("is_current"),
        F.col("_x").alias("extract_ts"),
    )
    any_new = fresh.agg(F.count(F.lit(1)).alias("_new")).withColumn("_one", F.lit(1))
    added = (
        added.withColumn("_one", F.lit(1))
        .join(F.broadcast(any_new), "_one")
        .filter(F.col("_new") == 0)
        .drop("_one", "_new")
    )
    return merged.unionByName(inserted).unionByName(added)
