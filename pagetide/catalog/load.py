"""Registered queries: bounds, loads, seen ids and table changes."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from pagetide import fixtures as fx
from pagetide.fixtures import FEEDS_SQL
from pagetide.operators import load as ld
from pagetide.registry import registry
from pagetide.sources import footers, layout, tables
from pagetide.sources.tables import scratch

Q, SQL, register = registry()
WITH = "with " + FEEDS_SQL
WINDOW = datetime(2024, 1, 12, 6)


def flat(df, owner, ts):
    return df.select("id", F.col(f"{owner}.id").alias("author_id"), "text", F.col(ts).alias("ts"))


def _pair(rows, ts):
    return fx.load_target(rows, ts), rows


def _bounds_sql(table: str, condition: str, window: str) -> str:
    return f"""select min(ts) filter (where {window}) as min_ts, max(ts) filter (where {window}) as max_ts,
  min(ts) as abs_min_ts, count(*) filter (where {window}) as window_count, count(*) as total_count
from {table} where {condition}"""


IN_WINDOW = "ts >= timestamp '2024-01-12 06:00:00'"


@register("watermark_bounds_messages", WITH + _bounds_sql("messages", "expired_ts is null and author_id = 3", IN_WINDOW))
def _(spark, d):
    return ld.watermark_bounds(fx.messages(spark, d), "createdAt", WINDOW, owner="u3", owner_col="fromUser")


@register(
    "watermark_bounds_posts",
    WITH
    + _bounds_sql(
        "posts", "expired_ts is null and author_id = 5", IN_WINDOW + " and ts <= timestamp '2024-01-20 00:00:00'"
    ),
)
def _(spark, d):
    return ld.watermark_bounds(
        fx.posts(spark, d), "postedAt", WINDOW, datetime(2024, 1, 20), owner="5", owner_col="author",
        require_owner=True,
    )


@register("watermark_bounds_purchases", WITH + _bounds_sql("purchases", "true", IN_WINDOW))
def _(spark, d):
    return ld.watermark_bounds(fx.purchases(spark, d), "unlockAt", WINDOW, active=False)


@register("watermark_bounds_footers", WITH + _bounds_sql("purchases", "true", IN_WINDOW))
def _(spark, d):
    path = scratch(spark, "purchases")
    rows = footers.with_at(fx.purchases(spark, d), "unlockAt")
    layout.create(rows, path, layout.month_of(F.col("unlockAt")), layout.MONTH)
    found = footers.watermark_bounds(spark, path, WINDOW)
    return spark.createDataFrame([tuple(found.values())], footers.FOUND)


PAGED = (
    ", paged as (select *, " + fx.PAGE_SQL + " as batch_seq from {table})\n"
)


@register(
    "batch_bounds",
    WITH + PAGED.format(table="messages") + "select batch_seq, min(ts) as min_ts, max(ts) as max_ts from paged group by 1",
)
def _(spark, d):
    return ld.batch_bounds(fx.feed_pages(fx.messages(spark, d)), "createdAt")


@register(
    "batch_counts",
    WITH
    + PAGED.format(table="purchases")
    + f"""select batch_seq, count(*) as n_rows, count(*) filter (where {IN_WINDOW}) as n_in_window,
  count(*) filter (where source = 'wall') as n_wall, count(*) filter (where source = 'chat') as n_chat
from paged group by 1""",
)
def _(spark, d):
    pages = fx.feed_pages(fx.purchases(spark, d))
    return ld.batch_counts(pages, "unlockAt", WINDOW, "unlockSource")


@register(
    "watermark_lookup",
    WITH + "select author_id, min(ts) as low, max(ts) as high from messages group by 1",
)
def _(spark, d):
    rows = fx.messages(spark, d)
    out = ld.watermark_lookup(rows, "createdAt", F.col("fromUser.id"))
    return out.select(F.col("_owner").alias("author_id"), F.col("_low").alias("low"), F.col("_high").alias("high"))


def _load_sql(table: str, owner: str, keys: str, dedup: bool = True, what: str = "inserted") -> str:
    bounds = f"select {owner} as o, min(ts) as lo, max(ts) as hi from target group by 1"
    new_key = f"or not exists (select 1 from target t where {keys})" if dedup else ""
    union = "union all select * from target" if what == "all" else ""
    return f"""{WITH}, target as (
  select * from {table} where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-20' and id % 7 <> 0),
bounds as ({bounds}),
inserted as (
  select m.* from {table} m left join bounds b on b.o = {owner.replace('author_id', 'm.author_id')}
  where b.lo is null or m.ts < b.lo or m.ts > b.hi {new_key}),
result as (select * from inserted {union})
select id, author_id, txt as text, ts from result"""


@register("incremental_load_messages", _load_sql("messages", "author_id", "t.id = m.id", what="all"))
def _(spark, d):
    target, batch = _pair(fx.messages(spark, d), "createdAt")
    return flat(ld.load_messages(target, batch)[0], "fromUser", "createdAt")


@register("incremental_load_messages_inserted", _load_sql("messages", "author_id", "t.id = m.id"))
def _(spark, d):
    target, batch = _pair(fx.messages(spark, d), "createdAt")
    return flat(ld.load_messages(target, batch)[1], "fromUser", "createdAt")


@register("incremental_load_posts", _load_sql("posts", "author_id", "t.id = m.id and t.author_id = m.author_id"))
def _(spark, d):
    target, batch = _pair(fx.posts(spark, d), "postedAt")
    return flat(ld.load_posts(target, batch)[1], "author", "postedAt")


@register(
    "incremental_load_purchases",
    _load_sql("purchases", "0", "t.id = m.id and t.response_type = m.response_type"),
)
def _(spark, d):
    target, batch = _pair(fx.purchases(spark, d), "unlockAt")
    return flat(ld.load_purchases(target, batch)[1], "author", "unlockAt")


@register("incremental_load_watermark_only", _load_sql("messages", "author_id", "", dedup=False))
def _(spark, d):
    target, batch = _pair(fx.messages(spark, d), "createdAt")
    return flat(ld.load_messages(target, batch, dedup=False)[1], "fromUser", "createdAt")


@register("late_gap_fill", _load_sql("messages", "author_id", "t.id = m.id") + " where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-20'")
def _(spark, d):
    target, batch = _pair(fx.messages(spark, d), "createdAt")
    new = flat(ld.load_messages(target, batch)[1], "fromUser", "createdAt")
    return new.filter("ts >= timestamp_ntz'2024-01-10' and ts < timestamp_ntz'2024-01-20'")


ANTI_SQL = WITH + """select id, author_id, txt as text, ts from messages m where not exists (
  select 1 from messages t where t.ts >= timestamp '2024-01-10' and t.ts < timestamp '2024-01-20'
    and t.id % 7 <> 0 and t.id = m.id)"""


@register("anti_existing", ANTI_SQL)
def _(spark, d):
    target, batch = _pair(fx.messages(spark, d), "createdAt")
    return flat(ld.anti_existing(batch, target, ["id"]), "fromUser", "createdAt")


@register("batch_scoped_anti", ANTI_SQL)
def _(spark, d):
    target, batch = _pair(fx.messages(spark, d), "createdAt")
    return flat(ld.batch_scoped_anti(batch, target, ["id"]), "fromUser", "createdAt")


@register(
    "pending_increment_count",
    WITH
    + """select count(*) as n_pending from messages m
where m.ts > (select coalesce(max(t.ts), timestamp '1900-01-01') from messages t
  where t.author_id = m.author_id and t.ts >= timestamp '2024-01-10' and t.ts < timestamp '2024-01-20'
    and t.id % 7 <> 0)""",
)
def _(spark, d):
    target, batch = _pair(fx.messages(spark, d), "createdAt")
    return ld.pending_increment_count(target, batch, "createdAt", "fromUser")


@register(
    "restrict_to_batch_keys",
    WITH
    + """select id, media_id from message_items m where exists (
  select 1 from purchase_items p where p.author_id = m.author_id and p.media_id = m.media_id)""",
)
def _(spark, d):
    def items(df, owner):
        return df.select(
            "id", F.col(f"{owner}.id").alias("author_id"), F.explode("media.id").alias("media_id")
        )

    kept = ld.restrict_to_batch_keys(
        items(fx.messages(spark, d), "fromUser"), items(fx.purchases(spark, d), "author"),
        ["author_id", "media_id"],
    )
    return kept.select("id", "media_id")


@register(
    "seen_state",
    WITH
    + PAGED.format(table="messages")
    + "select id, min(batch_seq) as first_seq, max(batch_seq) as last_seq from paged group by id",
)
def _(spark, d):
    return ld.seen_state(fx.feed_pages(fx.messages(spark, d)))


@register("in_seen", WITH + "select id, ts from messages where id in (select id from messages where id % 4 <> 0)")
def _(spark, d):
    rows = fx.messages(spark, d)
    seen = ld.seen_state(fx.feed_pages(fx.shown(rows)))
    return ld.in_seen(rows, seen).select("id", F.col("createdAt").alias("ts"))


@register("not_in_seen", WITH + "select id, ts from messages where id % 4 = 0")
def _(spark, d):
    rows = fx.messages(spark, d)
    seen = ld.seen_state(fx.feed_pages(fx.shown(rows)))
    return ld.not_in_seen(rows, seen).select("id", F.col("createdAt").alias("ts"))


@register(
    "append",
    WITH + "select id, txt as text, price from messages union all select id, txt, cast(null as double) from posts",
)
def _(spark, d):
    target = fx.messages(spark, d).select("id", "text", "price")
    return ld.append(target, fx.posts(spark, d).select("text", "id", "media"))


@register(
    "replace_keys",
    WITH
    + """select author_id, id, txt as text from messages where author_id not in (select author_id from posts where id % 7 = 3)
union all select author_id, id, txt from posts where id % 7 = 3""",
)
def _(spark, d):
    def rows(df, owner):
        return df.select(F.col(f"{owner}.id").alias("author_id"), "id", "text")

    changes = rows(fx.posts(spark, d), "author").filter("id % 7 = 3")
    return ld.replace_keys(rows(fx.messages(spark, d), "fromUser"), changes, ["author_id"])


@register("delete_where", WITH + "select id, price from messages where not coalesce(price > 50, false)")
def _(spark, d):
    return ld.delete_where(fx.messages(spark, d).select("id", "price"), F.col("price") > 50)


@register("overwrite", WITH + "select id, txt as text, cast(null as double) as price from posts")
def _(spark, d):
    target = fx.messages(spark, d).select("id", "text", "price")
    return ld.overwrite(target, fx.posts(spark, d).select("id", "text"))


@register(
    "delete_slice",
    WITH
    + """select id, author_id, txt as text, ts from posts
where not (author_id = 5 and cast(ts as date) >= date '2024-01-15')""",
)
def _(spark, d):
    kept = ld.delete_slice(fx.posts(spark, d), "author", 5, "postedAt", date(2024, 1, 15))
    return flat(kept, "author", "postedAt")


# -- the same on tables partitioned by month ----------------------------------------------


def _by_month(spark, rows, ts="ts"):
    """Rows as a stored table, partitioned by month."""
    path = tables.scratch(spark, "by-month")
    layout.create(rows, path, layout.month_of(F.col(ts)), layout.MONTH)
    return path


@register("replace_keys_partitioned", SQL["replace_keys"])
def _(spark, d):
    def rows(df, owner, ts):
        return df.select(F.col(f"{owner}.id").alias("author_id"), "id", "text", F.col(ts).alias("ts"))

    path = _by_month(spark, rows(fx.messages(spark, d), "fromUser", "createdAt"))
    changes = rows(fx.posts(spark, d), "author", "postedAt").filter("id % 7 = 3")
    layout.replace_keys(spark, path, changes, ["author_id"], layout.month_of(F.col("ts")))
    return layout.read(spark, path).select("author_id", "id", "text")


@register("delete_slice_partitioned", SQL["delete_slice"])
def _(spark, d):
    path = _by_month(spark, fx.posts(spark, d), "postedAt")
    layout.delete_slice(spark, path, "author", 5, "postedAt", date(2024, 1, 15))
    return flat(layout.read(spark, path), "author", "postedAt")


@register("batch_scoped_anti_partitioned", ANTI_SQL)
def _(spark, d):
    target, batch = _pair(fx.messages(spark, d), "createdAt")
    table = layout.read(spark, _by_month(spark, target, "createdAt"))
    return flat(layout.new_by_month(batch, table, ["id"], "createdAt"), "fromUser", "createdAt")
