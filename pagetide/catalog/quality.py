"""Registered queries: profiles, checks, small lookups and ordered scans."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from pagetide import fixtures as fx
from pagetide.fixtures import FEEDS_SQL
from pagetide.operators import quality as ql
from pagetide.plans import origin as og
from pagetide.registry import registry

Q, SQL, register = registry()
WITH = "with " + FEEDS_SQL


def _items(df, owner, ts):
    return df.select(
        "id", F.col(f"{owner}.id").alias("author_id"), F.explode("media.id").alias("media_id"),
        F.col(ts).alias("ts"),
    )


GRAIN = """select count(*) as n_rows, count(distinct ({keys})) as n_grain from {table}"""


@register("grain_check", WITH + GRAIN.format(keys="media_id, author_id", table="message_items"))
def _(spark, d):
    return ql.grain_check(_items(fx.messages(spark, d), "fromUser", "createdAt"), ["media_id", "author_id"])


@register("grain_check_lineitem", GRAIN.format(keys="l_orderkey, l_linenumber", table="lineitem"))
def _(spark, d):
    return ql.grain_check(fx.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register(
    "find_dupes",
    "select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by 1, 2 having count(*) > 1",
)
def _(spark, d):
    return ql.find_dupes(fx.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


PROFILE = """select '{t}' as table_name, count(*) as n_rows, count(distinct id) as n_ids, min(ts) as min_ts,
  max(ts) as max_ts, cast(null as bigint) as n_current, cast(null as bigint) as n_items,
  cast(null as bigint) as n_runs from {t}"""


@register(
    "table_profile",
    WITH
    + " union all ".join(PROFILE.format(t=t) for t in ("messages", "posts", "purchases"))
    + """ union all select 'items', count(*), count(distinct id), cast(null as timestamp), cast(null as timestamp),
  null, count(distinct media_id), null from message_items""",
)
def _(spark, d):
    return ql.table_profile(
        {
            "messages": fx.messages(spark, d),
            "posts": fx.posts(spark, d),
            "purchases": fx.purchases(spark, d),
            "items": _items(fx.messages(spark, d), "fromUser", "createdAt"),
        }
    )


SIZES = """select '{label}' as label, cast({size} as bigint) as n_chars, round({size} / 1048576.0, 2) as mib"""


@register(
    "payload_size",
    WITH
    + """, sized as (
  select cast((select sum(length(blob)) from message_items) + (select sum(2 + greatest(n - 1, 0)) from ev where event_type = 'click') as bigint) as a,
    cast((select sum(length('{"id":' || author_id || '}')) from messages) as bigint) as b)
select 'messages.media' as label, a as n_chars, round(a / 1048576, 2) as mib from sized
union all select 'messages.fromUser', b, round(b / 1048576, 2) from sized""",
)
def _(spark, d):
    return ql.payload_size(
        fx.messages(spark, d), {"messages.media": "media", "messages.fromUser": "fromUser"}
    )


@register("payload_size_full_rows")
def _(spark, d):
    # JSON text of whole rows differs between engines in number and time formats.
    return ql.payload_size(fx.messages(spark, d), {"messages (full row)": None})


@register(
    "text_size",
    WITH
    + """, sized as (select cast(sum(length(txt)) as bigint) as a, cast(sum(length(cast(n_media as varchar))) as bigint) as b from messages)
select 'text' as label, a as n_chars, round(a / 1048576, 2) as mib from sized
union all select 'mediaCount', b, round(b / 1048576, 2) from sized""",
)
def _(spark, d):
    return ql.text_size(fx.messages(spark, d), ["text", "mediaCount"])


@register(
    "table_stats",
    "select 'events' as table_name, count(*) as n_rows, 6 as n_columns from events "
    "union all select 'orders', count(*), 6 from orders union all select 'lineitem', count(*), 11 from lineitem",
)
def _(spark, d):
    return ql.table_stats({n: fx.table(spark, d, n) for n in ("events", "orders", "lineitem")})


@register(
    "active_expired_counts",
    WITH
    + " union all ".join(
        f"""select '{t}' as table_name, count(*) filter (where expired_ts is null) as active,
  count(*) filter (where expired_ts is not null) as expired from {t} where author_id in (1, 6)"""
        for t in ("messages", "posts")
    ),
)
def _(spark, d):
    return ql.active_expired_counts(
        {"messages": (fx.messages(spark, d), "fromUser"), "posts": (fx.posts(spark, d), "author")}, [1, "6"]
    )


@register("table_parity", WITH + """select
  (select count(*) from (select media_id from message_items except select media_id from post_items)) as only_in_a,
  (select count(*) from (select media_id from post_items except select media_id from message_items)) as only_in_b""")
def _(spark, d):
    a = _items(fx.messages(spark, d), "fromUser", "createdAt")
    b = _items(fx.posts(spark, d), "author", "postedAt")
    return ql.table_parity(a, b, exclude=["id", "author_id", "ts"])


@register("table_parity_bag", WITH + """select
  (select count(*) from (select media_id from message_items except all select media_id from post_items)) as only_in_a,
  (select count(*) from (select media_id from post_items except all select media_id from message_items)) as only_in_b""")
def _(spark, d):
    a = _items(fx.messages(spark, d), "fromUser", "createdAt")
    b = _items(fx.posts(spark, d), "author", "postedAt")
    return ql.table_parity(a, b, exclude=["id", "author_id", "ts"], bag=True)


@register("table_parity_by_digest", SQL["table_parity_bag"])
def _(spark, d):
    a = _items(fx.messages(spark, d), "fromUser", "createdAt")
    b = _items(fx.posts(spark, d), "author", "postedAt")
    return ql.table_parity_by_digest(a, b, exclude=["id", "author_id", "ts"], bag=True)


@register(
    "last_seen_date",
    WITH + "select author_id, media_id, max(cast(ts as date)) as last_seen from message_items group by 1, 2",
)
def _(spark, d):
    return ql.last_seen_date(fx.messages(spark, d))


@register("distinct_items", WITH + "select distinct media_id from purchase_items")
def _(spark, d):
    return og.distinct_items(fx.purchases(spark, d))


@register(
    "latest_n",
    WITH
    + """select id, response_type as "responseType", source as "unlockSource", ts as "unlockAt", price,
  n_media as "mediaCount", author_id from purchases order by ts desc limit 3""",
)
def _(spark, d):
    return ql.latest_n(fx.purchases(spark, d))


@register("top_item_ids", WITH + "select distinct media_id from purchase_items order by 1 desc limit 20")
def _(spark, d):
    return ql.top_item_ids(fx.purchases(spark, d))


@register(
    "next_item",
    WITH
    + """select author_id, id as post_id, media_id, ts as posted_ts,
  lead(media_id) over k as next_media_id, lead(ts) over k as next_media_id_ts
from post_items window k as (partition by author_id order by media_id, ts, id)""",
)
def _(spark, d):
    return ql.next_item(fx.posts(spark, d))


CLIMB = """, live as (select * from post_items where expired_ts is null),
climbing as (select *, max(media_id) over (partition by author_id order by ts) as top from live)
"""


@register(
    "running_max",
    WITH + CLIMB + "select author_id, id as post_id, media_id, ts as posted_ts, top as max_id_yet from climbing",
)
def _(spark, d):
    out = og.adjusted_ids(og.post_items(og.post_rows(fx.posts(spark, d))))
    return out.select("author_id", "post_id", "media_id", "posted_ts", "max_id_yet")


@register(
    "adjusted_id",
    WITH
    + CLIMB
    + "select author_id, id as post_id, media_id, greatest(media_id, top) as adjusted_id from climbing",
)
def _(spark, d):
    out = og.adjusted_ids(og.post_items(og.post_rows(fx.posts(spark, d))))
    return out.select("author_id", "post_id", "media_id", "adjusted_id")


@register(
    "next_adjusted",
    WITH
    + CLIMB
    + """select author_id, id as post_id, media_id, top as adjusted_id,
  coalesce(lead(top) over (partition by author_id order by top, ts, id, media_id), 99999999999) as next_adjusted_id
from climbing""",
)
def _(spark, d):
    out = og.next_adjusted(og.post_items(og.post_rows(fx.posts(spark, d))))
    return out.select("author_id", "post_id", "media_id", "adjusted_id", "next_adjusted_id")


@register(
    "order_totals",
    """select o_orderkey, o_custkey, l_partkey, l_quantity,
  sum(l_quantity) over (partition by o_orderkey) as total_quantity,
  round(l_quantity / sum(l_quantity) over (partition by o_orderkey), 2) as quantity_ratio
from orders join lineitem on l_orderkey = o_orderkey""",
)
def _(spark, d):
    """Items of an order with their share of the order's total, from flat tables."""
    from pagetide.functions.scalars import duration_ratio

    lines = fx.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_quantity"
    )
    orders = fx.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    # An order's lines are few: one window, whose partitioning the join uses again.
    total = F.sum("l_quantity").over(Window.partitionBy("o_orderkey"))
    return lines.withColumn("total_quantity", total).join(orders, "o_orderkey").select(
        "o_orderkey", "o_custkey", "l_partkey", "l_quantity", "total_quantity",
        duration_ratio("l_quantity", "total_quantity").alias("quantity_ratio"),
    )
