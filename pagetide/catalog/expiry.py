"""Registered queries: soft deletes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from pagetide import fixtures as fx
from pagetide.fixtures import FEEDS_SQL
from pagetide.operators import expiry as ex
from pagetide.registry import registry

Q, SQL, register = registry()
WINDOW, RUN = datetime(2024, 1, 5), datetime(2024, 2, 1, 10)
WITH = "with " + FEEDS_SQL


def _run(spark, d):
    """A run over all authors: messages, their pages and the ids seen."""
    rows = fx.messages(spark, d)
    paged = fx.feed_pages(fx.shown(rows))
    pages = paged.groupBy(F.col("fromUser.id").alias("author_id"), "batch_seq").agg(
        F.max("createdAt").alias("page_max")
    )
    stamp = F.timestamp_add("MINUTE", (F.col("batch_seq") % 1000).cast("int"), F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    return rows, pages.withColumn("processed_at", stamp), paged.select("batch_seq", "id")


def _flat(df):
    return df.select("id", F.col("fromUser.id").alias("author_id"), "createdAt", "expired_ts")


COLUMNS = 'id, author_id, ts as "createdAt", {e} as expired_ts from messages m'


@register(
    "revive_seen",
    WITH + "select " + COLUMNS.format(e="case when id % 4 = 0 then expired_ts end"),
)
def _(spark, d):
    rows, _, seen = _run(spark, d)
    return _flat(ex.revive_seen(rows, seen, "createdAt")[0])


@register(
    "revive_seen_changes",
    WITH
    + """select id, ts, 'revived' as action, cast(null as timestamp) as expired_ts from messages
where id % 4 <> 0 and expired_ts is not null""",
)
def _(spark, d):
    rows, _, seen = _run(spark, d)
    return ex.revive_seen(rows, seen, "createdAt")[1]


GONE = (
    "author_id = 3 and ts >= timestamp '2024-01-05' and expired_ts is null and id % 4 = 0"
)


@register(
    "expire_above_frontier",
    WITH
    + "select "
    + COLUMNS.format(
        e=f"case when {GONE} and ts > timestamp '2024-01-12 06:00:00' then timestamp '2024-02-01 10:00:00' else expired_ts end"
    ),
)
def _(spark, d):
    rows, _, seen = _run(spark, d)
    return _flat(
        ex.expire_above_frontier(
            rows, seen, author=3, owner_col="fromUser", ts="createdAt", window_start=WINDOW,
            frontier=datetime(2024, 1, 12, 6), run_ts=RUN,
        )[0]
    )


def _sweep(spark, d):
    rows, _, seen = _run(spark, d)
    return ex.expire_unseen(
        rows, seen, author=3, owner_col="fromUser", ts="createdAt", window_start=WINDOW, run_ts=RUN
    )


@register(
    "expire_unseen",
    WITH
    + "select "
    + COLUMNS.format(
        e=f"case when id % 4 <> 0 then null when {GONE} then timestamp '2024-02-01 10:00:00' else expired_ts end"
    ),
)
def _(spark, d):
    return _flat(_sweep(spark, d)[0])


@register(
    "expire_unseen_summary",
    WITH
    + f"""select count(*) filter (where {GONE}) as expired,
  count(*) filter (where id % 4 <> 0 and expired_ts is not null) as revived,
  min(ts) filter (where {GONE}) as earliest_expired_ts
from messages""",
)
def _(spark, d):
    return ex.change_summary(_sweep(spark, d)[1])


FRONTIERS = f""", day_pages as (
  select author_id, {fx.PAGE_SQL} as batch_seq, max(ts) as page_max
  from messages where id % 4 <> 0 group by 1, 2),
lowest as (
  select *, min(page_max) over (partition by author_id order by batch_seq
    rows between unbounded preceding and 1 preceding) as so_far from day_pages),
frontiers as (
  select author_id, batch_seq, page_max as frontier,
    timestamp '2024-02-01 00:00:00' + to_minutes(batch_seq % 1000) as stamp
  from lowest where page_max < so_far)
"""


@register("frontiers", WITH + FRONTIERS + "select * from frontiers")
def _(spark, d):
    return ex.frontiers(_run(spark, d)[1])


@register(
    "progressive_expire",
    WITH
    + FRONTIERS
    + "select "
    + COLUMNS.format(
        e="""case when id % 4 <> 0 then null when expired_ts is not null then expired_ts
    when ts >= timestamp '2024-01-05' then (
      select max_by(f.stamp, f.frontier) from frontiers f where f.author_id = m.author_id and f.frontier < m.ts) end"""
    ),
)
def _(spark, d):
    rows, pages, seen = _run(spark, d)
    return _flat(
        ex.progressive_expire(
            rows, pages, seen, owner_col="fromUser", ts="createdAt", window_start=WINDOW
        )[0]
    )


@register(
    "clear_expired",
    WITH + "select " + COLUMNS.format(e="case when author_id not in (1, 6) then expired_ts end"),
)
def _(spark, d):
    return _flat(ex.clear_expired(fx.messages(spark, d), ["1", 6], "fromUser", "createdAt")[0])


@register(
    "clear_expired_dry_run",
    WITH
    + """select id, ts, 'revived' as action, cast(null as timestamp) as expired_ts from messages
where author_id in (1, 6) and expired_ts is not null""",
)
def _(spark, d):
    return ex.clear_expired(fx.messages(spark, d), ["1", 6], "fromUser", "createdAt", dry_run=True)[1]
