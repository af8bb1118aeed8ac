"""Registered queries: origin reports and their steps."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from pagetide import fixtures as fx
from pagetide.fixtures import FEEDS_SQL
from pagetide.plans import origin as og
from pagetide.registry import registry

AS_OF = date(2024, 1, 31)

# The day bands as nested windows over single items, the plain form of the definition.
BANDS_SQL = """
live_posts as (select *, cast(ts as date) as d from post_items where expired_ts is null),
climbing as (
  select *, max(media_id) over (partition by author_id order by ts) as top from live_posts),
stepped as (
  select *, coalesce(lead(top) over (partition by author_id order by top, ts), 99999999999) as nxt
  from climbing),
bands as (
  select author_id, d, min(top) as first_id, max(nxt) as last_id from stepped group by author_id, d),
newest_post as (
  select * from (
    select *, row_number() over (partition by author_id, media_id order by ts desc, id desc) as rn
    from live_posts) where rn = 1)
"""


def ratio_sql(total: str) -> str:
    return f"round(i.duration * 1.0 / nullif({total}, 0), 2)"


MESSAGE_REPORT_SQL = (
    FEEDS_SQL
    + ","
    + BANDS_SQL
    + """,
live as (
  select *, cast(ts as date) as d,
    cast(sum(duration) over (partition by id) as bigint) as total
  from message_items where expired_ts is null),
report as (
  select i.txt as msg_text, i.d as created_date, i.media_id, cast(i.duration as integer) as duration,
    i.price as msg_price, i.n_media, round(i.duration * 1.0 / nullif(i.total, 0), 2) as duration_ratio,
    coalesce(b.d, date '1900-01-01') as approx_origin_date,
    w.d as wall_date, w.price as wall_price, w.txt as wall_text, i.author_id
  from live i
  left join bands b on b.author_id = i.author_id and i.media_id >= b.first_id and i.media_id < b.last_id
  left join newest_post w on w.author_id = i.author_id and w.media_id = i.media_id
  where i.duration > 0 and i.media_id not in (select media_id from purchase_items)
  qualify row_number() over (partition by i.author_id, i.media_id, i.id order by i.d desc) = 1)
"""
)

PURCHASE_REPORT_SQL = (
    FEEDS_SQL
    + ","
    + BANDS_SQL
    + """,
bought as (
  select *, cast(ts as date) as d, cast(sum(duration) over (partition by id) as bigint) as total
  from purchase_items),
report as (
  select i.txt as msg_text, i.d as unlock_date, i.source as ulk_src, i.media_id,
    cast(i.duration as integer) as duration,
    case when i.duration > 0 then 'video' else 'image' end as media_kind,
    i.price as msg_price, i.n_media, round(i.duration * 1.0 / nullif(i.total, 0), 2) as duration_ratio,
    coalesce(b.d, date '1900-01-01') as approx_origin_date,
    w.d as wall_date, w.price as wall_price, w.txt as wall_text, i.author_id
  from bought i
  left join bands b on b.author_id = i.author_id and i.media_id >= b.first_id and i.media_id < b.last_id
  left join newest_post w on w.author_id = i.author_id and w.media_id = i.media_id
  qualify row_number() over (partition by i.author_id, i.media_id, i.id order by i.d desc) = 1)
"""
)

Q, SQL, register = registry()


def _feeds(spark: SparkSession, d: str):
    return fx.messages(spark, d), fx.posts(spark, d), fx.purchases(spark, d)


@register(
    "origin_report_messages", "with " + MESSAGE_REPORT_SQL + "select * exclude (author_id) from report"
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return og.origin_report_messages(*_feeds(spark, d), as_of=AS_OF)


@register(
    "origin_report_messages_range_join",
    "with " + MESSAGE_REPORT_SQL + "select * exclude (author_id) from report",
)
def _(spark, d):
    return og.origin_report_messages(*_feeds(spark, d), as_of=AS_OF, lookup="join")


@register(
    "origin_report_messages_filtered",
    "with "
    + MESSAGE_REPORT_SQL
    + """select * exclude (author_id) from report
where author_id in (1, 3, 5)
  and (msg_text ilike '%CLICK 1%' or msg_text ilike '%k_7%')
  and coalesce(nullif(approx_origin_date, date '1900-01-01'), date '2024-01-31')
    >= date '2024-01-31' - 20""",
)
def _(spark, d):
    return og.origin_report_messages(
        *_feeds(spark, d),
        as_of=AS_OF,
        authors=[1, "3", 5],
        text_any=["CLICK 1", "k_7"],
        last_n_days=20,
    )


@register(
    "origin_report_purchases",
    "with "
    + PURCHASE_REPORT_SQL
    + "select * exclude (author_id, media_kind) from report where duration > 0",
)
def _(spark, d):
    return og.origin_report_purchases(fx.purchases(spark, d), fx.posts(spark, d), as_of=AS_OF)


@register(
    "origin_report_purchases_images",
    "with "
    + PURCHASE_REPORT_SQL
    + "select * exclude (author_id) from report where year(approx_origin_date) between 2023 and 2025",
)
def _(spark, d):
    return og.origin_report_purchases_images(
        fx.purchases(spark, d), fx.posts(spark, d), start_year=2025, end_year=2023
    )


@register(
    "origin_report_purchases_images_all_years",
    "with " + PURCHASE_REPORT_SQL + "select * exclude (author_id) from report",
)
def _(spark, d):
    return og.origin_report_purchases_images(fx.purchases(spark, d), fx.posts(spark, d))


@register(
    "origin_report_single_author",
    "with "
    + FEEDS_SQL
    + """,
live_posts as (
  select *, cast(ts as date) as d from post_items where expired_ts is null and author_id = 3),
climbing as (select *, max(media_id) over (order by ts) as top from live_posts),
stepped as (select *, coalesce(lead(top) over (order by top, ts), 99999999999) as nxt from climbing),
bands as (select d, min(top) as first_id, max(nxt) as last_id from stepped group by d),
newest_post as (
  select * from live_posts
  qualify row_number() over (partition by media_id order by ts desc, id desc) = 1),
live as (
  select *, cast(ts as date) as d, cast(sum(duration) over (partition by id) as bigint) as total
  from message_items where expired_ts is null and author_id = 3)
select i.d as created_date, i.media_id, cast(i.duration as integer) as duration,
  i.price as msg_price, i.n_media, round(i.duration * 1.0 / i.total, 2) as duration_ratio,
  coalesce(b.d, date '1900-01-01') as approx_origin_date,
  w.d as wall_date, w.price as wall_price, w.txt as wall_text
from live i
left join bands b on i.media_id >= b.first_id and i.media_id < b.last_id
left join newest_post w on w.media_id = i.media_id
where i.duration > 0 and year(coalesce(b.d, date '2024-01-31')) >= 2024
qualify row_number() over (partition by i.media_id, i.id order by i.d desc) = 1""",
)
def _(spark, d):
    return og.origin_report_single_author(
        fx.messages(spark, d), fx.posts(spark, d), 3, as_of=AS_OF, min_year=2024
    )


@register(
    "origin_report_per_item",
    "with "
    + FEEDS_SQL
    + """,
all_posts as (select *, cast(ts as date) as d from post_items),
climbing as (
  select *, max(media_id) over (partition by author_id order by ts) as top from all_posts),
stepped as (
  select *, coalesce(lead(top) over (partition by author_id order by top, ts), 99999999999) as nxt
  from climbing),
bands as (
  select author_id, d, min(top) as first_id, max(nxt) as last_id from stepped group by author_id, d),
rows_ as (
  select *, cast(ts as date) as d, cast(sum(duration) over (partition by id) as bigint) as total
  from message_items)
select i.author_id, i.id as chat_id, i.txt as msg_text, i.d as created_date, i.media_id,
  cast(i.duration as integer) as media_duration, i.price as msg_price, i.n_media as media_count,
  round(i.duration * 1.0 / i.total, 2) as duration_ratio, b.d as approx_origin_date
from rows_ i
left join bands b on b.author_id = i.author_id and i.media_id >= b.first_id and i.media_id < b.last_id
where i.duration > 0 and year(b.d) >= 2024
qualify row_number() over (
  partition by i.author_id, i.media_id
  order by i.d desc, i.ts desc, i.duration desc, i.txt desc, i.id desc) = 1""",
)
def _(spark, d):
    return og.origin_report_per_item(fx.messages(spark, d), fx.posts(spark, d), min_year=2024)


@register(
    "origin_by_windows",
    "with "
    + MESSAGE_REPORT_SQL
    + """select w.last_n_days, r.* exclude (author_id)
from report r join (values (2), (5), (10), (20), (365)) w(last_n_days)
on coalesce(nullif(approx_origin_date, date '1900-01-01'), date '2024-01-31')
  >= date '2024-01-31' - w.last_n_days""",
)
def _(spark, d):
    return og.origin_by_windows(*_feeds(spark, d), as_of=AS_OF, days=(2, 5, 10, 20, 365))


@register(
    "origin_by_windows_purchases",
    "with "
    + PURCHASE_REPORT_SQL
    + """select w.last_n_days, r.* exclude (author_id, media_kind)
from report r join (values (30), (60), (90), (180), (365)) w(last_n_days)
on coalesce(nullif(approx_origin_date, date '1900-01-01'), date '2024-02-10')
  >= date '2024-02-10' - w.last_n_days
where duration > 0""",
)
def _(spark, d):
    return og.origin_by_windows(
        *_feeds(spark, d), as_of=date(2024, 2, 10), source="purchases"
    )


@register(
    "day_bands",
    "with " + FEEDS_SQL + "," + BANDS_SQL + "select author_id, d as posted_date, first_id, last_id from bands",
)
def _(spark, d):
    return og.day_bands(og.post_rows(fx.posts(spark, d)))


@register(
    "day_bands_over_all",
    "with "
    + FEEDS_SQL
    + """,
live as (select *, cast(ts as date) as d from post_items where expired_ts is null),
climbing as (select *, max(media_id) over (order by ts) as top from live),
stepped as (select *, coalesce(lead(top) over (order by top, ts), 99999999999) as nxt from climbing)
select author_id, d as posted_date, min(top) as first_id, max(nxt) as last_id
from stepped group by author_id, d""",
)
def _(spark, d):
    return og.day_bands(og.post_rows(fx.posts(spark, d)), per_author=False)


KEYS_ORIGIN_SQL = (
    "with "
    + FEEDS_SQL
    + ","
    + BANDS_SQL
    + """select k.author_id, k.media_id, b.d as origin_date
from (select distinct author_id, media_id from message_items) k
left join bands b on b.author_id = k.author_id and k.media_id >= b.first_id and k.media_id < b.last_id"""
)


def _keys(spark, d):
    rows = og.message_rows(fx.messages(spark, d), include_expired=True)
    return og.explode_items(rows, ["author_id"]).select(*og.KEY).distinct()


@register("band_lookup", KEYS_ORIGIN_SQL)
def _(spark, d):
    return og.band_lookup(_keys(spark, d), og.day_bands(og.post_rows(fx.posts(spark, d))))


@register("band_join", KEYS_ORIGIN_SQL)
def _(spark, d):
    return og.band_join(_keys(spark, d), og.day_bands(og.post_rows(fx.posts(spark, d))))


@register(
    "exact_join",
    "with "
    + FEEDS_SQL
    + ","
    + BANDS_SQL
    + """select i.id as row_id, i.author_id, i.media_id, i.duration, w.d as wall_date,
  w.id as post_id, w.txt as wall_text, w.price as wall_price
from message_items i left join newest_post w on w.author_id = i.author_id and w.media_id = i.media_id""",
)
def _(spark, d):
    rows = og.message_rows(fx.messages(spark, d), include_expired=True)
    items = og.explode_items(rows, ["row_id", "author_id"])
    return og.exact_join(items, og.post_rows(fx.posts(spark, d)))


@register(
    "anti_purchased",
    "with "
    + FEEDS_SQL
    + """select id as row_id, author_id, media_id, duration from message_items
where media_id not in (select media_id from purchase_items)""",
)
def _(spark, d):
    rows = og.message_rows(fx.messages(spark, d), include_expired=True)
    return og.anti_purchased(og.explode_items(rows, ["row_id", "author_id"]), fx.purchases(spark, d))


@register(
    "total_per_row",
    "with "
    + FEEDS_SQL
    + """select m.id as row_id, m.author_id,
  cast(coalesce((select sum(duration) from message_items i where i.id = m.id), 0) as bigint) as total_duration
from messages m where m.expired_ts is null""",
)
def _(spark, d):
    rows = og.message_rows(fx.messages(spark, d))
    return og.total_per_row(rows, ["row_id"]).select("row_id", "author_id", "total_duration")


@register(
    "dedup_latest",
    "with "
    + FEEDS_SQL
    + """select author_id, media_id, id as row_id, cast(ts as date) as row_date from message_items
qualify row_number() over (partition by author_id, media_id order by ts desc, id desc, pos) = 1""",
)
def _(spark, d):
    rows = og.message_rows(fx.messages(spark, d), include_expired=True)
    items = og.explode_items(rows, ["row_id", "author_id", "row_ts", "row_date"])
    return og.dedup_latest(items, og.KEY, F.col("row_ts").desc(), F.col("row_id").desc()).select(
        *og.KEY, "row_id", "row_date"
    )


@register(
    "band_join_unscoped",
    "with "
    + FEEDS_SQL
    + ","
    + BANDS_SQL
    + """select k.author_id, k.media_id, b.d as origin_date
from (select distinct author_id, media_id from message_items) k
left join bands b on b.author_id = 3 and k.media_id >= b.first_id and k.media_id < b.last_id""",
)
def _(spark, d):
    bands = og.day_bands(og.post_rows(fx.posts(spark, d))).filter("author_id = 3")
    return og.band_join_unscoped(_keys(spark, d), bands)


@register(
    "report_order",
    "with "
    + MESSAGE_REPORT_SQL
    + """select duration_ratio, duration, min(place) as place, count(*) as n
from (select *, rank() over (order by duration_ratio desc nulls last, duration desc nulls last) as place from report)
group by 1, 2""",
)
def _(spark, d):
    """Where rows stand in the report's order, by the values that decide it."""
    return og.report_ranks(og.origin_report_messages(*_feeds(spark, d), as_of=AS_OF, ordered=False))
