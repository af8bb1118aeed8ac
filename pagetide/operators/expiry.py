"""Soft deletes: rows that leave the feed get ``expired_ts``, rows that return lose it.

Each operator returns the new target and the changed rows, both lazily.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from pagetide.functions.scalars import as_ts, digits_id, micros, numeric_id, owner_key, ts_lit
from pagetide.plans.skew import running_max
from pagetide.sources.tables import stored


def _null_ts() -> Column:
    return F.lit(None).cast("timestamp_ntz")


def seen_ids(seen: DataFrame) -> DataFrame:
    """Distinct numeric ids of a seen table."""
    return (
        seen.select(numeric_id(seen, "id").alias("id"))
        .filter(F.col("id").isNotNull())
        .distinct()
    )


def _flagged(target: DataFrame, seen: DataFrame, owner_col: str | None = None) -> DataFrame:
    """Target with ``_seen``; with an owner column only ids seen for that owner count."""
    if owner_col is None:
        ids, keys, rows = seen_ids(seen), ["_id"], target
        ids = ids.select(F.col("id").alias("_id"), F.lit(True).alias("_seen"))
    else:
        ids = (
            seen.select(digits_id("id").alias("_id"), F.col("author_id").cast("bigint").alias("_owner"))
            .distinct()
            .withColumn("_seen", F.lit(True))
        )
        keys = ["_id", "_owner"]
        rows = target.withColumn("_owner", owner_key(target, owner_col))
    # Ids identify the target's rows and are distinct among the seen, so no key can be hot.
    rows = rows.withColumn("_id", F.col("id").cast("bigint"))
    return rows.join(ids, keys, "left").withColumn("_seen", F.col("_seen").isNotNull())


def _split(marked: DataFrame, target: DataFrame, ts: str) -> tuple[DataFrame, DataFrame]:
    new = marked.select(*[F.col("_new").alias(c) if c == "expired_ts" else F.col(c) for c in target.columns])
    changes = marked.filter(F.col("_action").isNotNull()).select(
        "id", as_ts(target, ts).alias("ts"), F.col("_action").alias("action"), F.col("_new").alias("expired_ts")
    )
    return new, changes


def revive_seen(
    target: DataFrame, seen: DataFrame, ts: str, owner_col: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Clear ``expired_ts`` of the rows whose id was seen.

    Ids are matched over all authors, as the default; ``owner_col`` scopes them.
    """
    flagged = _flagged(target, seen, owner_col)
    back = F.col("_seen") & F.col("expired_ts").isNotNull()
    marked = flagged.select(
        "*",
        F.when(back, F.lit("revived")).alias("_action"),
        F.when(F.col("_seen"), _null_ts()).otherwise(F.col("expired_ts")).alias("_new"),
    )
    return _split(marked, target, ts)


def _expirable(target: DataFrame, owner_col: str, author: int, ts: str, window_start: datetime) -> Column:
    mine = owner_key(target, owner_col) == int(author)
    return F.coalesce(
        mine
        & (as_ts(target, ts) >= ts_lit(window_start))
        & F.col("expired_ts").isNull()
        & F.col("id").isNotNull(),
        F.lit(False),
    )


def expire_above_frontier(
    target: DataFrame,
    seen: DataFrame,
    *,
    author: int | None,
    owner_col: str,
    ts: str,
    window_start: datetime,
    frontier: datetime | None,
    run_ts: datetime,
) -> tuple[DataFrame, DataFrame]:
    """Expire the author's active in-window rows newer than the frontier that were not seen."""
    if author is None or frontier is None:
        return target, _no_changes(target, ts)
    flagged = _flagged(target, seen)
    gone = (
        _expirable(target, owner_col, author, ts, window_start)
        & (as_ts(target, ts) > ts_lit(frontier))
        & ~F.col("_seen")
    )
    marked = flagged.select(
        "*",
        F.when(gone, F.lit("expired")).alias("_action"),
        F.when(gone, ts_lit(run_ts)).otherwise(F.col("expired_ts")).alias("_new"),
    )
    return _split(marked, target, ts)


def _no_changes(target: DataFrame, ts: str) -> DataFrame:
    return target.limit(0).select(
        "id", as_ts(target, ts).alias("ts"), F.lit("").alias("action"), "expired_ts"
    )


def expire_unseen(
    target: DataFrame,
    seen: DataFrame,
    *,
    author: int,
    owner_col: str,
    ts: str,
    window_start: datetime,
    run_ts: datetime,
) -> tuple[DataFrame, DataFrame]:
    """Final sweep: revive what was seen, then expire every active in-window row that was not."""
    flagged = _flagged(target, seen)
    gone = _expirable(target, owner_col, author, ts, window_start) & ~F.col("_seen")
    back = F.col("_seen") & F.col("expired_ts").isNotNull()
    marked = flagged.select(
        "*",
        F.when(gone, F.lit("expired")).when(back, F.lit("revived")).alias("_action"),
        F.when(gone, ts_lit(run_ts))
        .when(F.col("_seen"), _null_ts())
        .otherwise(F.col("expired_ts"))
        .alias("_new"),
    )
    return _split(marked, target, ts)


def change_summary(changes: DataFrame) -> DataFrame:
    """Counts of expired and revived rows and the earliest time among the expired."""
    gone = F.col("action") == "expired"
    return changes.agg(
        F.count_if(gone).alias("expired"),
        F.count_if(F.col("action") == "revived").alias("revived"),
        F.min(F.when(gone, F.col("ts"))).alias("earliest_expired_ts"),
    )


def frontiers(pages: DataFrame) -> DataFrame:
    """Pages of a run that advance the frontier: author_id, batch_seq, frontier, stamp.

    A page advances when its newest row is older than the newest row of every page before
    it; the first page only sets the start. ``pages`` has author_id, batch_seq, page_max and
    processed_at, one row per page of the author's run.
    """
    known = pages.filter(F.col("page_max").isNotNull()).withColumn("_max", micros("page_max"))
    before = running_max(
        known, ["author_id"], "batch_seq", -F.col("_max"), "_neg_lowest", inclusive=False
    )
    return before.filter(F.col("_max") < -F.col("_neg_lowest")).select(
        "author_id",
        "batch_seq",
        F.col("page_max").alias("frontier"),
        F.col("processed_at").alias("stamp"),
    )


def progressive_expire(
    target: DataFrame,
    pages: DataFrame,
    seen: DataFrame,
    *,
    owner_col: str,
    ts: str,
    window_start: datetime,
    sweep: tuple[int, datetime] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """State of the target after a whole run of pages, in one pass.

    Equals reviving and expiring page by page: a row seen on any page ends active; a row
    never seen that was active, in the window and newer than some frontier is stamped by the
    first page that passed it, which is the one with the highest frontier below its time;
    all other rows stay as they were. ``sweep`` (author, time) is the final sweep: what the
    author still has active, in the window and unseen is stamped with that time.

    The target is read twice: once, in its narrow columns, for the open unseen rows of the
    pages' authors, whose stamps come from a running maximum over frontiers and those rows
    by time; once for the result. Rows of other authors leave before anything is shuffled.
    """
    when = as_ts(target, ts)
    owner = owner_key(target, owner_col)
    is_open = F.col("expired_ts").isNull() & F.col("id").isNotNull() & owner.isNotNull() & (when >= ts_lit(window_start))
    ids = seen_ids(seen).select(F.col("id").alias("_id"))
    stops = frontiers(pages).select(
        F.col("author_id").cast("bigint").alias("_owner"),
        micros("frontier").alias("_pos"),
        F.struct("frontier", "stamp").alias("_stop"),
    )
    stops = stored(stops)
    unseen = (
        target.filter(is_open)
        .select(F.col("id").cast("bigint").alias("_id"), owner.alias("_owner"), when.alias("_when"))
        .join(stops.select("_owner").distinct(), "_owner", "left_semi")
        .join(ids, "_id", "left_anti")
        .distinct()
        .withColumn("_pos", micros("_when"))
    )
    both = stored(unseen.unionByName(stops, allowMissingColumns=True))
    passed = running_max(both, ["_owner"], "_pos", F.col("_stop"), "_last", inclusive=False, bits=28)
    stamps = passed.filter("_id is not null and _last is not null").select(
        "_id", "_owner", "_when", F.col("_last.stamp").alias("_stamp")
    )
    rows = target.withColumns({"_id": F.col("id").cast("bigint"), "_owner": owner, "_when": when})
    flagged = rows.join(ids.withColumn("_seen", F.lit(True)), "_id", "left").join(stamps, ["_id", "_owner", "_when"], "left")
    stamp = F.when(is_open, F.col("_stamp"))
    if sweep is not None:
        author, at = sweep
        left_over = is_open & F.col("_seen").isNull() & (owner == int(author))
        stamp = F.coalesce(stamp, F.when(left_over, ts_lit(at)))
    back = F.col("_seen").isNotNull() & F.col("expired_ts").isNotNull()
    marked = flagged.withColumn("_at", stamp).select(
        "*",
        F.when(F.col("_at").isNotNull(), F.lit("expired")).when(back, F.lit("revived")).alias("_action"),
        F.when(F.col("_at").isNotNull(), F.col("_at"))
        .when(F.col("_seen").isNotNull(), _null_ts())
        .otherwise(F.col("expired_ts"))
        .alias("_new"),
    )
    return _split(marked, target, ts)


def clear_expired(
    target: DataFrame, authors: Iterable[int | str], owner_col: str, ts: str, dry_run: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Undo the soft deletes of the given authors; a dry run only lists what it would clear."""
    mine = owner_key(target, owner_col).isin([int(a) for a in authors])
    cleared = F.coalesce(mine & F.col("expired_ts").isNotNull(), F.lit(False))
    marked = target.select(
        "*",
        F.when(cleared, F.lit("revived")).alias("_action"),
        F.when(cleared, _null_ts()).otherwise(F.col("expired_ts")).alias("_new"),
    )
    new, changes = _split(marked, target, ts)
    return (target if dry_run else new), changes
