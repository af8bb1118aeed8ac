"""Watermarks, incremental loads and plain table changes, as (target, changes) -> target."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from pagetide.functions.scalars import as_ts, digits_id, owner_key, ts_lit
from pagetide.plans.skew import hot_keys, skew_join

EPOCH = datetime(1970, 1, 1)


# -- bounds ------------------------------------------------------------------------------


def watermark_bounds(
    df: DataFrame,
    ts: str,
    window_start: datetime | None,
    window_end: datetime | None = None,
    owner: str | None = None,
    owner_col: str | None = None,
    active: bool = True,
    require_owner: bool = False,
) -> DataFrame:
    """One row: min_ts, max_ts, abs_min_ts, window_count, total_count.

    The window includes both ends. ``active`` leaves out expired rows. ``owner`` may hold
    non-digits; without one, ``require_owner`` decides between no rows and all rows.
    """
    when = as_ts(df, ts)
    inside = when >= ts_lit(window_start or EPOCH)
    if window_end is not None:
        inside = inside & (when <= ts_lit(window_end))
    rows = df.filter(F.col("expired_ts").isNull()) if active else df
    digits = "".join(ch for ch in str(owner or "") if ch.isdigit())
    if digits:
        rows = rows.filter(owner_key(df, owner_col) == int(digits))
    elif require_owner:
        rows = rows.filter(F.lit(False))
    return rows.agg(
        F.min(F.when(inside, when)).alias("min_ts"),
        F.max(F.when(inside, when)).alias("max_ts"),
        F.min(when).alias("abs_min_ts"),
        F.count_if(inside).alias("window_count"),
        F.count(F.lit(1)).alias("total_count"),
    )


def batch_bounds(pages: DataFrame, ts: str) -> DataFrame:
    """Oldest and newest valid time of each page."""
    when = as_ts(pages, ts)
    return pages.groupBy("batch_seq").agg(F.min(when).alias("min_ts"), F.max(when).alias("max_ts"))


def batch_counts(
    pages: DataFrame, ts: str, min_ts: datetime | None, source: str | None = None
) -> DataFrame:
    """Rows and in-window rows of each page and, for purchases, rows by source."""
    inside = F.lit(True) if min_ts is None else as_ts(pages, ts) >= ts_lit(min_ts)
    counts = [F.count(F.lit(1)).alias("n_rows"), F.count_if(inside).alias("n_in_window")]
    if source:
        counts += [
            F.count_if(F.col(source) == "wall").alias("n_wall"),
            F.count_if(F.col(source) == "chat").alias("n_chat"),
        ]
    return pages.groupBy("batch_seq").agg(*counts)


def watermark_lookup(target: DataFrame, ts: Column | str, owner: Column | None = None) -> DataFrame:
    """Oldest and newest time of the target, expired rows included, per owner or overall."""
    when = as_ts(target, ts) if isinstance(ts, str) else ts
    ends = [F.min(when).alias("_low"), F.max(when).alias("_high")]
    rows = target.groupBy(owner.alias("_owner")) if owner is not None else target.groupBy(
        F.lit(0).alias("_owner")
    )
    return rows.agg(*ends)


# -- loads -------------------------------------------------------------------------------


def existing_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct target keys that the batch holds too.

    The semi join comes first: for a small batch it is a broadcast filter on the target's
    key columns, so the target is not shuffled. For a large one both sides are plain
    shuffles, which adaptive execution may split where a key of the target is hot.
    """
    wanted = batch.select(*keys)
    return target.select(*keys).join(wanted, list(keys), "left_semi").distinct()


def batch_scoped_anti(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key is not in the target, with the target cut to the batch's keys."""
    return skew_join(batch, existing_keys(target, batch, keys), keys, "left_anti")


def anti_existing(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key is not in the target; rows with a null key stay."""
    return skew_join(batch, target.select(*keys).distinct(), keys, "left_anti")


def new_rows(
    target: DataFrame,
    batch: DataFrame,
    ts: str,
    id_keys: dict[str, str],
    owner: str | None = None,
    dedup: bool = True,
    dedup_batch: bool = False,
) -> DataFrame:
    """Batch rows to insert: before the owner's oldest, after its newest, or of a new key.

    Bounds and keys are those of the target before the batch, expired rows included.
    ``id_keys`` maps key names to columns, ``owner`` is an owner column; without one the
    bounds are global. Rows that repeat within the batch are all inserted unless
    ``dedup_batch`` is set.
    """

    def keyed(df: DataFrame) -> DataFrame:
        extra = {
            f"_k{i}": (owner_key(df, c) if c == owner else F.col(c))
            for i, c in enumerate(id_keys.values())
        }
        extra["_owner"] = owner_key(df, owner) if owner else F.lit(0)
        extra["_ts"] = as_ts(df, ts)
        return df.withColumns(extra)

    keys = [f"_k{i}" for i in range(len(id_keys))]
    have, come = keyed(target), keyed(batch)
    bounds = watermark_lookup(have, F.col("_ts"), F.col("_owner"))
    if dedup_batch:
        come = come.dropDuplicates(keys)
    # Without an owner the bounds are a single row.
    rows = (
        skew_join(come, bounds, ["_owner"], "left", spread=keys)
        if owner
        else come.join(F.broadcast(bounds), "_owner", "left")
    )
    outside = (
        F.col("_low").isNull() & F.col("_ts").isNotNull()
        | (F.col("_ts") < F.col("_low"))
        | (F.col("_ts") > F.col("_high"))
    )
    if dedup:
        known = existing_keys(have, come, keys).withColumn("_known", F.lit(True))
        rows = skew_join(rows, known, keys, "left", hot=hot_keys(come, keys))
        take = F.coalesce(outside, F.lit(False)) | F.col("_known").isNull()
    else:
        take = outside
    return rows.filter(take).select(*batch.columns)


def incremental_load(
    target: DataFrame,
    batch: DataFrame,
    ts: str,
    id_keys: Sequence[str],
    owner: str | None = None,
    dedup: bool = True,
    dedup_batch: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """New target and inserted rows. Both frames must have the target's columns."""
    inserted = new_rows(
        target, batch, ts, {k: k for k in id_keys}, owner, dedup, dedup_batch
    )
    return target.unionByName(inserted, allowMissingColumns=True), inserted


def load_messages(target: DataFrame, batch: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Messages: bounds per sender, key ``id`` over the whole table."""
    return incremental_load(target, batch, "createdAt", ["id"], "fromUser", **options)


def load_posts(target: DataFrame, batch: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Posts: bounds per author, key (author, id)."""
    return incremental_load(target, batch, "postedAt", ["author", "id"], "author", **options)


def load_purchases(target: DataFrame, batch: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Purchases: global bounds, key (response type, id)."""
    return incremental_load(target, batch, "unlockAt", ["responseType", "id"], None, **options)


def pending_increment_count(target: DataFrame, batch: DataFrame, ts: str, owner: str) -> DataFrame:
    """Number of batch rows newer than their owner's newest row."""
    bounds = watermark_lookup(target, ts, owner_key(target, owner))
    rows = batch.select(owner_key(batch, owner).alias("_owner"), as_ts(batch, ts).alias("_ts"))
    per_owner = skew_join(rows, bounds, ["_owner"], "left")
    newer = F.col("_high").isNull() | (F.col("_ts") > F.col("_high"))
    return per_owner.agg(F.count_if(newer & F.col("_ts").isNotNull()).alias("n_pending"))


# -- seen ids ----------------------------------------------------------------------------


def seen_state(pages: DataFrame, id_col: str = "id") -> DataFrame:
    """First and last page of each id over the run; ids without digits are left out."""
    return (
        pages.select("batch_seq", digits_id(id_col).alias("id"))
        .filter(F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.min("batch_seq").alias("first_seq"), F.max("batch_seq").alias("last_seq"))
    )


def in_seen(df: DataFrame, seen: DataFrame, id_col: str = "id") -> DataFrame:
    ids = seen.select(F.col("id").alias(id_col)).filter(F.col(id_col).isNotNull()).distinct()
    return skew_join(df, ids, [id_col], "left_semi")


def not_in_seen(df: DataFrame, seen: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows with an id that was not seen; with nothing seen, all rows with an id."""
    ids = seen.select(F.col("id").alias(id_col)).filter(F.col(id_col).isNotNull()).distinct()
    return skew_join(df.filter(F.col(id_col).isNotNull()), ids, [id_col], "left_anti")


# -- plain changes -----------------------------------------------------------------------


def append(target: DataFrame, changes: DataFrame) -> DataFrame:
    """Target with the changes below it, matched by column name."""
    return target.unionByName(changes.select(*[c for c in target.columns if c in changes.columns]),
                              allowMissingColumns=True)


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    """Target without the rows for which the condition is true; unknown keeps the row."""
    return target.filter(~F.coalesce(condition, F.lit(False)))


def replace_keys(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target with all rows of the changed keys replaced."""
    changed = changes.select(*keys).distinct()
    return append(skew_join(target, changed, keys, "left_anti"), changes)


def overwrite(target: DataFrame, changes: DataFrame) -> DataFrame:
    """The changes in the target's shape."""
    return append(target.limit(0), changes)


def delete_slice(
    target: DataFrame, owner_col: str, owner: int, ts: str | None = None, from_date: date | None = None
) -> DataFrame:
    """Target without an owner's rows, optionally only those from a date on."""
    condition = owner_key(target, owner_col) == int(owner)
    if from_date is not None:
        condition = condition & (F.to_date(as_ts(target, ts)) >= F.lit(from_date))
    return delete_where(target, condition)


def restrict_to_batch_keys(df: DataFrame, batch: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows whose key occurs in the batch, without repeating any."""
    keys = list(keys)
    return skew_join(df, batch.select(*keys).distinct(), keys, "left_semi")
