"""Messages, posts and purchases derived from the ``events`` table.

Nothing is kept between queries: each derives what it reads. The same mapping is stated in
SQL in ``FEEDS_SQL``, for checks on another engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _items(backwards: bool) -> str:
    """SQL for the item array: the first ``event_id % 5`` of four items."""
    shift = "CASE WHEN k % 33 = 0 THEN 900L ELSE 0L END" if backwards else "0L"
    duration = "CAST(floor(value) AS BIGINT) * ((event_id + {i}) % 3)"
    item = (
        "named_struct('id', grp * 8 + (event_id + {i}) % 8 + " + shift + ", "
        "'type', IF(" + duration + " > 0, 'video', 'photo'), 'convertedToVideo', false, "
        "'canView', true, 'hasError', false, 'createdAt', CAST(CAST(ts AS DATE) AS STRING), "
        "'isReady', true, 'duration', " + duration + ", 'hasCustomPreview', false)"
    )
    four = ", ".join(item.format(i=i) for i in range(4))
    return f"slice(array({four}), 1, CAST(event_id % 5 AS INT)) AS media"


OWNER = "named_struct('id', author_id)"
TEXT = "concat_ws(' ', event_type, k) AS text"
PRICE = "CASE WHEN k % 2 = 0 THEN value END AS price"
COUNT = "CAST(event_id % 5 AS INT) AS mediaCount"
EXPIRED = "CASE WHEN k % 13 = 5 THEN ts + INTERVAL '1' DAY END AS expired_ts"


def _events(spark: SparkSession, sf_dir: str, *types: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type").isin(*types))
        .selectExpr(
            "event_id",
            "CAST(ts AS TIMESTAMP_NTZ) AS ts",
            "event_type",
            "value",
            "CAST(get_json_object(props, '$.k') AS BIGINT) AS k",
            "event_id div 6 AS grp",
            "(event_id div 6) % 7 AS author_id",
        )
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, "click").selectExpr(
        "event_id AS id",
        f"{OWNER} AS fromUser",
        TEXT,
        PRICE,
        COUNT,
        _items(False),
        "ts AS createdAt",
        EXPIRED,
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, "view").selectExpr(
        "event_id AS id",
        f"{OWNER} AS author",
        TEXT,
        PRICE,
        _items(True),
        "ts AS postedAt",
        EXPIRED,
    )


def raw_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as the feed gives them: post-shaped and message-shaped rows mixed."""
    stamp = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
    return _events(spark, sf_dir, "purchase", "signup").selectExpr(
        "CAST(NULL AS STRING) AS responseType",
        "event_id AS id",
        f"CASE WHEN event_type = 'purchase' THEN {OWNER} END AS author",
        f"CASE WHEN event_type = 'signup' THEN {OWNER} END AS fromUser",
        TEXT,
        PRICE,
        COUNT,
        "k % 2 = 0 AS isOpened",
        "true AS isMediaReady",
        f"IF(event_type = 'purchase', {stamp}, '') AS postedAt",
        f"CASE WHEN event_type = 'signup' THEN {stamp} END AS createdAt",
        _items(False),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, "purchase", "signup").selectExpr(
        "IF(event_type = 'purchase', 'post', 'message') AS responseType",
        "IF(event_type = 'purchase', 'wall', 'chat') AS unlockSource",
        "event_id AS id",
        f"{OWNER} AS author",
        TEXT,
        PRICE,
        COUNT,
        "k % 2 = 0 AS isOpened",
        "true AS isMediaReady",
        "ts AS unlockAt",
        _items(False),
    )


def load_target(rows: DataFrame, ts: str) -> DataFrame:
    """A table loaded earlier: ten days of the feed with every seventh row missing."""
    return rows.filter(
        (F.col(ts) >= F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"))
        & (F.col(ts) < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
        & (F.col("id") % 7 != 0)
    )


# Ids follow time, so counting them down from a fixed number gives newest-first pages of at
# most this many rows, however long the feed.
PAGE_ROWS, PAGE_BASE = 300, 2**40
#: Pages that share a file where a whole feed is written: some megabytes.
PAGES_PER_FILE = 128
PAGE_SQL = f"cast(({PAGE_BASE} - id) // {PAGE_ROWS} as bigint)"


def feed_pages(rows: DataFrame) -> DataFrame:
    """Feed rows with the number of their page."""
    return rows.withColumn("batch_seq", F.expr(f"({PAGE_BASE}L - id) div {PAGE_ROWS}"))


def shown(rows: DataFrame) -> DataFrame:
    """What the feed still shows: a quarter of the rows is gone."""
    return rows.filter(F.col("id") % 4 != 0)


#: Places at the end of a page whose rows the next page repeats.
REPEATED = 30


def overlapping_pages(rows: DataFrame) -> DataFrame:
    """Feed pages of which each begins with the last rows of the page before it."""
    last = F.expr(f"({PAGE_BASE}L - id) % {PAGE_ROWS}") >= PAGE_ROWS - REPEATED
    seq = F.col("batch_seq")
    return feed_pages(rows).withColumn(
        "batch_seq", F.explode(F.when(last, F.array(seq, seq + 1)).otherwise(F.array(seq)))
    )


OVERLAP_SQL = (
    f"unnest(case when ({PAGE_BASE} - id) % {PAGE_ROWS} >= {PAGE_ROWS - REPEATED} "
    f"then [{PAGE_SQL}, {PAGE_SQL} + 1] else [{PAGE_SQL}] end)"
)


FEEDS_SQL = """
ev as (
  select event_id, ts, event_type, value,
    cast(json_extract_string(props, '$.k') as bigint) as k,
    event_id // 6 as grp, (event_id // 6) % 7 as author_id, event_id % 5 as n,
    event_type || ' ' || cast(json_extract_string(props, '$.k') as bigint) as txt
  from events),
feed_rows as (
  select event_id as id, event_type, author_id, txt, ts, k,
    case when k % 2 = 0 then value end as price, cast(n as integer) as n_media,
    case when k % 13 = 5 and event_type in ('click', 'view') then ts + interval 1 day end as expired_ts
  from ev),
feed_items as (
  select e.event_id as id, e.event_type, e.author_id, i.pos,
    e.grp * 8 + (e.event_id + i.pos) % 8
      + case when e.event_type = 'view' and e.k % 33 = 0 then 900 else 0 end as media_id,
    cast(floor(e.value) as bigint) * ((e.event_id + i.pos) % 3) as duration,
    strftime(e.ts, '%Y-%m-%d') as item_created,
    '{"id":' || media_id || ',"type":"' || case when duration > 0 then 'video' else 'photo' end
      || '","convertedToVideo":false,"canView":true,"hasError":false,"createdAt":"' || item_created
      || '","isReady":true,"duration":' || duration || ',"hasCustomPreview":false}' as blob
  from ev e join (values (0), (1), (2), (3)) i(pos) on i.pos < e.n),
messages as (select * from feed_rows where event_type = 'click'),
message_items as (
  select r.id, r.author_id, r.txt, r.price, r.n_media, r.ts, r.expired_ts, i.media_id,
    i.duration, i.pos, i.blob
  from messages r join feed_items i on i.id = r.id),
posts as (select * from feed_rows where event_type = 'view'),
post_items as (
  select r.id, r.author_id, r.txt, r.price, r.n_media, r.ts, r.expired_ts, i.media_id,
    i.duration, i.pos, i.blob
  from posts r join feed_items i on i.id = r.id),
purchases as (
  select *, case event_type when 'purchase' then 'post' else 'message' end as response_type,
    case event_type when 'purchase' then 'wall' else 'chat' end as source
  from feed_rows where event_type in ('purchase', 'signup')),
purchase_items as (
  select r.id, r.author_id, r.txt, r.price, r.n_media, r.ts, r.source, i.media_id,
    i.duration, i.pos, i.blob
  from purchases r join feed_items i on i.id = r.id)
"""
