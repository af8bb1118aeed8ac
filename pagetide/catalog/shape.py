"""Registered queries: feed shaping, filters and scalar functions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from pagetide import fixtures as fx, schemas as S
from pagetide.fixtures import FEEDS_SQL
from pagetide.functions import scalars as sc
from pagetide.operators import filters as flt, quality as ql, shape as sh
from pagetide.plans import origin as og
from pagetide.registry import registry

Q, SQL, register = registry()
WITH = "with " + FEEDS_SQL


def _flat(df, *keep):
    """Item fields next to the row's columns, one row per item."""
    return df.select(*keep, F.inline("media"))


def _all_items(spark, d):
    rows = og.message_rows(fx.messages(spark, d), include_expired=True)
    return og.explode_items(rows, ["row_id", "author_id", "msg_text", "row_ts"])


ITEM_SQL = """
  media_id as id, case when duration > 0 then 'video' else 'photo' end as type,
  false as "convertedToVideo", true as "canView", false as "hasError",
  strftime(ts, '%Y-%m-%d') as "createdAt", true as "isReady", duration, false as "hasCustomPreview"
"""


@register("trim_items", WITH + "select id as row_id," + ITEM_SQL + "from message_items")
def _(spark, d):
    # Two fields the feed may add are cut away again.
    rows = fx.messages(spark, d).withColumn(
        "media", F.transform("media", lambda m: m.withField("source", F.lit("x")).withField("n", F.lit(1)))
    )
    return _flat(sh.trim_items(rows).withColumnRenamed("id", "row_id"), "row_id")


@register("normalize_items", WITH + "select id as row_id," + ITEM_SQL + "from message_items")
def _(spark, d):
    loose = F.transform(
        "media",
        lambda m: F.struct(
            m["id"].cast("string").alias("id"),
            m["type"].alias("type"),
            F.lit(None).cast("string").alias("convertedToVideo"),
            F.lit("true").alias("canView"),
            m["createdAt"].alias("createdAt"),
            F.lit("true").alias("isReady"),
            F.nullif(m["duration"].cast("string"), F.lit("0")).alias("duration"),
        ),
    )
    rows = fx.messages(spark, d).withColumn("media", loose)
    return _flat(sh.normalize_items(rows).withColumnRenamed("id", "row_id"), "row_id")


@register("drop_bulky", WITH + "select id, txt as text, price, ts as \"postedAt\", expired_ts from posts")
def _(spark, d):
    rows = fx.posts(spark, d).drop("author", "media").withColumns(
        {"isMarkdownDisabled": F.lit(True), "fundRaising": F.lit("{}"), "linkedPosts": F.lit("[]")}
    )
    return sh.drop_bulky(rows)


@register(
    "normalize_purchases",
    WITH
    + """select response_type as "responseType", source as "unlockSource", p.id, p.author_id,
  p.txt as text, p.price, n_media as "mediaCount", k % 2 = 0 as "isOpened", p.ts as unlock_ts,
  i.media_id, i.duration
from purchases p left join feed_items i on i.id = p.id""",
)
def _(spark, d):
    out = sh.normalize_purchases(fx.raw_purchases(spark, d))
    return out.select(
        "responseType", "unlockSource", "id", F.col("author.id").alias("author_id"), "text", "price",
        "mediaCount", "isOpened", sc.parse_ts("unlockAt").alias("unlock_ts"), F.explode_outer("media").alias("m"),
    ).select("*", F.col("m.id").alias("media_id"), F.col("m.duration").alias("duration")).drop("m")


@register(
    "in_window",
    WITH + "select id, ts as \"createdAt\" from messages where ts >= timestamp '2024-01-12 06:00:00'",
)
def _(spark, d):
    return sh.in_window(fx.messages(spark, d), "createdAt", datetime(2024, 1, 12, 6)).select("id", "createdAt")


@register("explode_items", WITH + "select id as row_id, author_id, media_id, duration from message_items")
def _(spark, d):
    return _all_items(spark, d).select("row_id", "author_id", "media_id", "duration")


@register(
    "owner_id", WITH + "select id, cast(author_id as varchar) as from_struct, cast(author_id as varchar) as from_json from posts"
)
def _(spark, d):
    rows = fx.posts(spark, d).withColumn("owner_json", F.to_json("author"))
    return rows.select(
        "id",
        sc.owner_id(rows, "author").alias("from_struct"),
        sc.owner_id(rows, "owner_json").alias("from_json"),
    )


@register("multi_extract", WITH + "select id as row_id, media_id, duration as media_duration from message_items")
def _(spark, d):
    blobs = fx.messages(spark, d).select(F.col("id").alias("row_id"), F.explode("media").alias("m"))
    parsed = blobs.select("row_id", sc.multi_extract(F.to_json("m"), "id BIGINT, duration BIGINT").alias("f"))
    return parsed.select("row_id", F.col("f.id").alias("media_id"), F.col("f.duration").alias("media_duration"))


@register(
    "digits_id",
    "select event_id, try_cast(nullif(regexp_replace(props, '[^0-9]', '', 'g'), '') as bigint) as digits, "
    "try_cast(nullif(regexp_replace(event_type, '[^0-9]', '', 'g'), '') as bigint) as none from events",
)
def _(spark, d):
    return fx.table(spark, d, "events").select(
        "event_id", sc.digits_id("props").alias("digits"), sc.digits_id("event_type").alias("none")
    )


@register(
    "author_from_url",
    WITH
    + """select id, case when k % 3 < 2 then cast(author_id as varchar) end as author
from messages""",
)
def _(spark, d):
    k = F.substring_index("text", " ", -1).cast("int") % 3
    url = (
        F.when(k == 0, F.concat(F.lit("https://site.test/my/chats/chat/"), "fromUser.id", F.lit("/?q=1")))
        .when(k == 1, F.concat(F.lit("https://site.test/"), "fromUser.id", F.lit("/")))
        .otherwise("https://site.test/home")
    )
    return fx.messages(spark, d).select("id", sc.author_from_url(url).alias("author"))


@register(
    "duration_ratio",
    WITH
    + """select id as row_id, media_id, duration,
  round(duration * 1.0 / nullif(cast(sum(duration) over (partition by id) as bigint), 0), 2) as ratio
from message_items""",
)
def _(spark, d):
    rows = og.total_per_row(og.message_rows(fx.messages(spark, d), include_expired=True), ["row_id"], unique=True)
    items = og.explode_items(rows, ["row_id", "total_duration"])
    return items.select(
        "row_id", "media_id", "duration", sc.duration_ratio("duration", "total_duration").alias("ratio")
    )


@register(
    "item_kind",
    WITH
    + """select id as row_id, media_id, case when duration > 0 then 'video' else 'image' end as kind
from purchase_items""",
)
def _(spark, d):
    items = og.explode_items(og.purchase_rows(fx.purchases(spark, d)), ["row_id"])
    return items.select("row_id", "media_id", sc.item_kind("duration").alias("kind"))


@register("only_video", WITH + "select id as row_id, media_id, duration from message_items where duration > 0")
def _(spark, d):
    return flt.only_video(_all_items(spark, d)).select("row_id", "media_id", "duration")


@register("filter_authors", WITH + "select id as row_id, media_id from message_items where author_id in (2, 4)")
def _(spark, d):
    return flt.filter_authors(_all_items(spark, d), ["2", 4]).select("row_id", "media_id")


@register(
    "filter_authors_table",
    WITH + "select id as row_id, media_id from message_items where author_id in (select c_nationkey from customer)",
)
def _(spark, d):
    ids = fx.table(spark, d, "customer").select("c_nationkey")
    return flt.filter_authors(_all_items(spark, d), ids).select("row_id", "media_id")


@register(
    "filter_text_any",
    WITH + "select id, txt as text from messages where txt ilike '%CK 3%' or txt ilike '%k_9%' or txt ilike '%none%'",
)
def _(spark, d):
    rows = fx.messages(spark, d).select("id", "text")
    return flt.filter_text_any(rows, ["CK 3", "k_9", "none"], "text")


@register(
    "filter_text_any_table",
    WITH + "select id, txt as text from messages where txt ilike '%CK 3%' or txt ilike '%k_9%'",
)
def _(spark, d):
    rows = fx.messages(spark, d).select("id", "text")
    parts = spark.createDataFrame([("CK 3",), ("k_9",), (None,)], "part string")
    return flt.filter_text_any(rows, parts, "text")


@register(
    "filter_item_ids",
    WITH + "select id as row_id, media_id from message_items where media_id in (select media_id from purchase_items)",
)
def _(spark, d):
    ids = og.distinct_items(fx.purchases(spark, d))
    return flt.filter_item_ids(_all_items(spark, d), ids).select("row_id", "media_id")


def _origins(spark, d):
    keys = _all_items(spark, d).select(*og.KEY).distinct()
    return og.band_join(keys, og.day_bands(og.post_rows(fx.posts(spark, d))))


def _origin_sql(condition: str) -> str:
    from pagetide.catalog.origin import BANDS_SQL

    return (
        WITH
        + ","
        + BANDS_SQL
        + f"""select k.author_id, k.media_id, b.d as origin_date
from (select distinct author_id, media_id from message_items) k
left join bands b on b.author_id = k.author_id and k.media_id >= b.first_id and k.media_id < b.last_id
where {condition}"""
    )


@register("filter_origin_days", _origin_sql("coalesce(b.d, date '2024-01-31') >= date '2024-01-31' - 12"))
def _(spark, d):
    return flt.filter_origin_days(_origins(spark, d), 12, date(2024, 1, 31))


@register("filter_origin_years", _origin_sql("year(coalesce(b.d, date '1900-01-01')) between 2023 and 2024"))
def _(spark, d):
    return flt.filter_origin_years(_origins(spark, d), 2024, 2023)


@register("filter_origin_min_year", _origin_sql("year(coalesce(b.d, date '2024-01-31')) >= 2024"))
def _(spark, d):
    return flt.filter_origin_min_year(_origins(spark, d), 2024, date(2024, 1, 31))


@register("active_only", WITH + "select id, ts as \"postedAt\" from posts where expired_ts is null")
def _(spark, d):
    return flt.active_only(fx.posts(spark, d)).select("id", "postedAt")


@register("select_exclude", "select * exclude (props, value) from events")
def _(spark, d):
    rows = fx.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return sh.select_exclude(rows, "props", "value")


@register(
    "item_lookup",
    WITH
    + """select id as chat_id, author_id, media_id, price as msg_price, duration as media_duration,
  cast(ts as date) as created_date, txt as msg_text
from message_items where author_id = 0 and media_id = 342""",
)
def _(spark, d):
    return ql.item_lookup(fx.messages(spark, d), 0, 342)


@register(
    "item_listing",
    WITH
    + """select id as chat_id, author_id, media_id, price as msg_price, duration as media_duration,
  cast(ts as date) as created_date, txt as msg_text
from message_items where duration > 0""",
)
def _(spark, d):
    return ql.item_listing(fx.messages(spark, d))


@register(
    "ensure_columns",
    WITH + "select id, txt as text, cast(null as timestamp) as expired_ts, cast(null as double) as price from posts",
)
def _(spark, d):
    rows = fx.posts(spark, d).select("id", "text")
    return sh.ensure_columns(rows, {"text": "string", "expired_ts": S.TS, "price": "double"})


@register(
    "align_to_schema",
    WITH
    + """select id, '{"id":' || author_id || '}' as author, txt as text, price, n_media as "mediaCount",
  ts as "createdAt", cast(null as timestamp) as expired_ts from messages""",
)
def _(spark, d):
    rows = fx.messages(spark, d).select(
        "id", F.col("fromUser").alias("author"), "text", "price", "mediaCount",
        F.date_format("createdAt", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("createdAt"),
        F.lit("dropped").alias("extra"),
    )
    schema = S.struct(
        id=S.LONG, author=S.STRING, text=S.STRING, price=S.DOUBLE, mediaCount=S.INT,
        createdAt=S.TS, expired_ts=S.TS,
    )
    return sh.align_to_schema(rows, schema)


@register("empty_like", WITH + "select id, txt as text, price from messages where false")
def _(spark, d):
    return sh.empty_like(fx.messages(spark, d).select("id", "text", "price"))
