"""Registered queries: feed files and page-by-page loads under Structured Streaming."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from pagetide import fixtures as fx, schemas as S
from pagetide.fixtures import FEEDS_SQL
from pagetide.functions import scalars as sc
from pagetide.operators import dimension as dm, load as ld, shape as sh
from pagetide.sources import feeds, tables
from pagetide.streaming import keyed as kd, pages as pg
from pagetide.registry import registry

Q, SQL, register = registry()
WITH = "with " + FEEDS_SQL
WINDOW, RUN = datetime(2024, 1, 5), datetime(2024, 2, 1, 10)
BATCH_BYTES = 2**30  # page files of a micro-batch; results do not depend on it


def _folder(spark, name):
    return tables.scratch(spark, name)


def _iso(c):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(c)


def _message_feed(rows):
    return rows.select(
        "id", "fromUser", "text", "price", "mediaCount", "media", _iso("createdAt"), "batch_seq"
    )


def _post_feed(rows):
    return rows.select("id", "author", "text", "price", "media", _iso("postedAt"), "batch_seq")


ITEM_ROWS = """select m.id, m.author_id, m.txt as text, m.price, n_media as "mediaCount", m.ts as "createdAt",
  i.media_id, i.duration
from messages m left join feed_items i on i.id = m.id"""


def _item_rows(df):
    return df.select(
        "id", F.col("fromUser.id").alias("author_id"), "text", "price", "mediaCount",
        sc.parse_ts("createdAt").alias("createdAt"), F.explode_outer("media").alias("m"),
    ).select("*", F.col("m.id").alias("media_id"), F.col("m.duration").alias("duration")).drop("m")


@register("write_feed_json", WITH + ITEM_ROWS)
def _(spark, d):
    path = _folder(spark, "feed")
    rows = _message_feed(fx.messages(spark, d).withColumn("batch_seq", F.lit(0))).drop("batch_seq")
    feeds.write_feed_json(rows, path)
    return _item_rows(spark.read.schema(S.MESSAGE_FEED).json(path))


@register("read_feed_log", WITH + ITEM_ROWS)
def _(spark, d):
    path = _folder(spark, "log")
    feeds.write_feed_log(_message_feed(fx.feed_pages(fx.messages(spark, d))), path)
    return _item_rows(feeds.read_feed_log(spark, path, S.MESSAGE_FEED))


@register("read_feed_json", WITH + ITEM_ROWS)
def _(spark, d):
    path = _folder(spark, "array")
    rows = _message_feed(fx.feed_pages(fx.messages(spark, d)))
    feeds.write_feed_arrays(rows, path, per_file=fx.PAGES_PER_FILE)
    return _item_rows(feeds.read_feed_json(spark, f"{path}/*", S.MESSAGE_FEED))


@register("read_feed_union", WITH + ITEM_ROWS.replace("m.ts as", "case when m.id % 10 < 5 then m.ts end as").replace("n_media as", "n_media::bigint as"))
def _(spark, d):
    """Pages of which half lack a field, the other half have one more, and one is broken."""
    path = _folder(spark, "mixed")
    rows = _message_feed(fx.feed_pages(fx.messages(spark, d)))
    feeds.write_feed_arrays(rows.filter("id % 10 >= 5").drop("createdAt"), f"{path}/without", per_file=fx.PAGES_PER_FILE)
    feeds.write_feed_arrays(rows.filter("id % 10 < 5").withColumn("pinned", F.lit(True)), f"{path}/more", per_file=fx.PAGES_PER_FILE)
    rows.limit(1).select(F.lit('[{"id": 1, "text": ').alias("value")).write.text(f"{path}/broken/batch_seq=0")
    found, _ = feeds.read_feed_union(spark, f"{path}/*/*")
    return _item_rows(found)


def _streamed(spark, feed, before, feed_rows, window=WINDOW, dim=None, **options):
    """What a run over the pages of ``feed_rows`` makes of the table ``before`` it."""
    root, path = _folder(spark, "run"), _folder(spark, "pages")
    pg.write_pages(feed_rows, path, RUN, minutes=True, per_file=fx.PAGES_PER_FILE)
    run = pg.Run(spark, feed, root, window, RUN, **options)
    run.start(before, dim, dim)
    pg.stream_load(run, path, max_bytes=BATCH_BYTES)
    return pg.finish_run(run)


def _messages(spark, d, before=None, **options):
    rows = fx.messages(spark, d)
    paged = _message_feed(fx.overlapping_pages(fx.shown(rows)))
    # The table loaded earlier is some columns of the stored events wherever a run reads it: copying it whole costs more.
    before = fx.load_target(rows, "createdAt") if before is None else before
    return _streamed(spark, pg.MESSAGES, before, paged, **options)


def _posts(spark, d, **options):
    rows = fx.posts(spark, d)
    paged = _post_feed(fx.overlapping_pages(fx.shown(rows)))
    return _streamed(spark, pg.POSTS, fx.load_target(rows, "postedAt"), paged, **options)


# A row that two pages repeat is loaded once, by the first of them.
STREAM = (
    """, target as (
  select * from {table} where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-20' and id % 7 <> 0),
inserted as (
  select a.* replace (cast(null as timestamp) as expired_ts), """
    + fx.PAGE_SQL
    + """ as seq from {table} a
  where id % 4 <> 0 and ts >= timestamp '2024-01-05' and not exists (select 1 from target t where t.id = a.id)),
loaded as (select * from target union all select * exclude (seq) from inserted),
page_rows as (select *, """
    + fx.OVERLAP_SQL
    + """ as batch_seq from {table} where id % 4 <> 0),
pages as (
  select batch_seq, count(*) as n_rows,
    count(*) filter (where ts >= timestamp '2024-01-05') as n_in_window, max(ts) as raw_max,
    max(ts) filter (where ts >= timestamp '2024-01-05') as in_window_max,
    (select count(*) from inserted i where i.seq = page_rows.batch_seq) as inserted
  from page_rows group by 1)
"""
)
FLAT = 'id, author_id, ts as "{ts}", {e} as expired_ts from loaded'


def _flat(out, owner, ts):
    return out.target.select("id", F.col(f"{owner}.id").alias("author_id"), ts, "expired_ts")


@register(
    "stream_load_messages",
    WITH + STREAM.format(table="messages") + "select " + FLAT.format(ts="createdAt", e="case when id % 4 = 0 then expired_ts end"),
)
def _(spark, d):
    return _flat(_messages(spark, d), "fromUser", "createdAt")


@register(
    "stream_load_messages_backfill",
    WITH
    + STREAM.format(table="messages")
    + "select "
    + FLAT.format(
        ts="createdAt",
        e="""case when id % 4 <> 0 then null
    when expired_ts is null and author_id = 3 and ts >= timestamp '2024-01-05' then timestamp '2024-02-01 10:00:00'
    else expired_ts end""",
    ),
)
def _(spark, d):
    return _flat(_messages(spark, d, author=3, force_backfill=True), "fromUser", "createdAt")


# The dimension before the run has the table's items. A page looks at the rows it loaded, the
# first also at the table's; what lies inside the range known by then stays out.
DIM = """, items as (
  select distinct id, author_id, media_id, duration as media_duration, blob as media_blob, ts as valid_from_ts
  from message_items),
dim0 as (
  select distinct i.author_id, media_id, media_duration, media_blob, valid_from_ts,
    timestamp '2024-01-20 07:30:15' as extract_ts
  from items i join target t using (id)),
looked_at as (
  select id, author_id, ts, seq from inserted where n_media > 0
  union all select id, author_id, ts, (select min(seq) from inserted) from target where n_media > 0),
marks as (
  select author_id, seq, min(ts) as lo, max(ts) as hi from looked_at group by 1, 2
  union all select author_id, -1, min(valid_from_ts), max(valid_from_ts) from dim0 group by 1),
ranges as (
  select author_id, seq, min(lo) over w as lo, max(hi) over w as hi from marks
  window w as (partition by author_id order by seq rows between unbounded preceding and 1 preceding)),
increment as (
  select distinct i.author_id, media_id, media_duration, media_blob, valid_from_ts,
    timestamp '2024-02-01 05:00:00' as extract_ts, l.seq
  from looked_at l join ranges r on r.author_id = l.author_id and r.seq = l.seq join items i on i.id = l.id
  where lo is null or valid_from_ts < lo or valid_from_ts > hi),
numbered as (
  select *, cast(row_number() over k as integer) as seen_count, lead(valid_from_ts) over k as valid_to_ts
  from (select * from dim0 union select * exclude (seq) from increment)
  window k as (partition by author_id, media_id order by valid_from_ts, extract_ts, media_blob, media_duration)),
by_page as (
  select p.seq as page, v.* exclude (seq)
  from (select distinct author_id, media_id, seq from increment) p
  join (select *, -1 as seq from dim0 union select * from increment) v
    on v.author_id = p.author_id and v.media_id = p.media_id and v.seq <= p.seq),
added as (
  select author_id, media_id, valid_from_ts, cast(row_number() over k as integer) as seen_count,
    lead(valid_from_ts) over k as valid_to_ts
  from by_page
  window k as (partition by page, author_id, media_id order by valid_from_ts, extract_ts, media_blob, media_duration)),
numbered0 as (
  select author_id, media_id, valid_from_ts, cast(row_number() over k as integer) as seen_count,
    lead(valid_from_ts) over k as valid_to_ts
  from dim0
  window k as (partition by author_id, media_id order by valid_from_ts, extract_ts, media_blob, media_duration))
"""
VERSIONS = ["author_id", "media_id", "valid_from_ts", "seen_count", "valid_to_ts"]


def _with_dim(spark, d):
    empty = tables.empty(spark, S.dim_schema())
    target = tables.stored(fx.load_target(fx.messages(spark, d), "createdAt"))
    first = dm.dim_increment(target, empty, datetime(2024, 1, 20, 12, 30, 15))
    return _messages(spark, d, before=target, dim=tables.stored(dm.scd2_rebuild(empty, tables.stored(first))))


@register(
    "stream_load_dimension",
    WITH + STREAM.format(table="messages") + DIM + f"select {', '.join(VERSIONS)} from numbered",
)
def _(spark, d):
    return _with_dim(spark, d).dim.select(*VERSIONS)


@register(
    "stream_load_history",
    WITH
    + STREAM.format(table="messages")
    + DIM
    + f"select {', '.join(VERSIONS)} from added union all select {', '.join(VERSIONS)} from numbered0",
)
def _(spark, d):
    return _with_dim(spark, d).history.select(*VERSIONS)


JUDGED = """, judged as (
  select *, case when batch_seq = (select max(batch_seq) from pages) then 'hasMore'
    when raw_max < timestamp '2024-01-05' then 'cutoff'
    when coalesce(in_window_max, raw_max) < timestamp '2024-01-19' and inserted = 0 then 'high_watermark'
    end as stop_reason from pages)
"""


@register(
    "batch_stop_reason",
    WITH
    + STREAM.format(table="messages")
    + JUDGED
    + "select batch_seq, n_rows, n_in_window, raw_max, in_window_max, inserted, stop_reason from judged",
)
def _(spark, d):
    return _messages(spark, d, high_watermark=datetime(2024, 1, 19)).pages.select(
        "batch_seq", "n_rows", "n_in_window", "raw_max", "in_window_max", "inserted", "stop_reason"
    )


@register(
    "sweep_gate",
    WITH
    + STREAM.format(table="messages")
    + JUDGED
    + """, stop as (
  select min(batch_seq) as stop_seq, min_by(stop_reason, batch_seq) as stop_reason
  from judged where stop_reason is not null)
select stop_seq, stop_reason, coalesce(stop_reason in ('hasMore', 'cutoff'), false) as sweep from stop""",
)
def _(spark, d):
    out = _messages(spark, d, high_watermark=datetime(2024, 1, 19))
    return out.stop.select("stop_seq", "stop_reason", pg.sweep_gate(F.col("stop_reason"), forced=True).alias("sweep"))


@register(
    "stream_load_posts",
    WITH + STREAM.format(table="posts") + "select " + FLAT.format(ts="postedAt", e="case when id % 4 = 0 then expired_ts end"),
)
def _(spark, d):
    return _flat(_posts(spark, d), "author", "postedAt")


# Posts are stamped by the clock of the page that passed them by, the rest by the run's.
STAMPS = """, lowest as (
  select *, min(raw_max) over (order by batch_seq rows between unbounded preceding and 1 preceding) as so_far
  from pages),
passing as (
  select batch_seq, raw_max, timestamp '2024-02-01 10:00:00'
      + to_minutes(batch_seq - (select min(batch_seq) from pages)) as stamp
  from lowest where raw_max < so_far and batch_seq <= (
    select min(batch_seq) from pages
    where raw_max < timestamp '2024-01-05' or batch_seq = (select max(batch_seq) from pages)))
"""
STAMPED = """case when id % 4 <> 0 then null
    when expired_ts is not null or author_id <> 5 or ts < timestamp '2024-01-05' then expired_ts
    else coalesce((select min_by(stamp, batch_seq) from passing p where p.raw_max < loaded.ts),
      timestamp '2024-02-01 10:00:00') end"""


@register(
    "stream_load_posts_backfill",
    WITH + STREAM.format(table="posts") + STAMPS + "select " + FLAT.format(ts="postedAt", e=STAMPED),
)
def _(spark, d):
    return _flat(_posts(spark, d, author=5, force_backfill=True), "author", "postedAt")


@register(
    "expiry_stamp",
    WITH
    + STREAM.format(table="posts")
    + STAMPS
    + f"""select expired_ts, count(*) as n_rows from (select {FLAT.format(ts="postedAt", e=STAMPED)})
where expired_ts >= timestamp '2024-02-01 10:00:00' group by 1""",
)
def _(spark, d):
    out = _flat(_posts(spark, d, author=5, force_backfill=True), "author", "postedAt")
    new = out.filter(F.col("expired_ts") >= F.lit("2024-02-01 10:00:00").cast("timestamp_ntz"))
    return new.groupBy("expired_ts").agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "stream_load_historical",
    WITH
    + STREAM.format(table="posts").replace("2024-01-05", "2024-01-01")
    + "select "
    + FLAT.format(ts="postedAt", e="case when id % 4 = 0 then expired_ts end"),
)
def _(spark, d):
    """A forced run over past years loads what it finds and never expires a row."""
    past = pg.historical_window(2024, 2024)
    out = _posts(
        spark, d, window=past.load_from, author=5, force_backfill=True, historical=True,
        cutoff_reason=past.cutoff_reason, jump_seq=0,
    )
    return _flat(out, "author", "postedAt")


@register(
    "stream_load_purchases",
    WITH
    + STREAM.format(table="purchases").replace("id % 4 <> 0", "true")
    + """select id, author_id, response_type as "responseType", source as "unlockSource", ts as "unlockAt"
from loaded""",
)
def _(spark, d):
    paged = fx.overlapping_pages(fx.raw_purchases(spark, d))
    out = _streamed(spark, pg.PURCHASES, fx.load_target(fx.purchases(spark, d), "unlockAt"), paged)
    return out.target.select(
        "id", F.col("author.id").alias("author_id"), "responseType", "unlockSource", "unlockAt"
    )


@register(
    "historical_window",
    WITH
    + """select min(ts) filter (where w) as min_ts, max(ts) filter (where w) as max_ts, min(ts) as abs_min_ts,
  count(*) filter (where w) as window_count, count(*) as total_count
from (select *, ts between timestamp '2023-01-01' and timestamp '2024-01-01' as w from posts
  where expired_ts is null and author_id = 5)""",
)
def _(spark, d):
    past = pg.historical_window(2024, 2023)
    return ld.watermark_bounds(
        fx.posts(spark, d), "postedAt", past.load_from, past.known_until, owner="5", owner_col="author",
        require_owner=True,
    )


@register("rolling_cutoff", WITH + "select id from purchases where ts >= timestamp '2024-01-21 10:00:00'")
def _(spark, d):
    return sh.in_window(fx.purchases(spark, d), "unlockAt", sh.rolling_cutoff(11, RUN)).select("id")


@register(
    "versioned_tables",
    WITH + "select id, txt as text, price from messages where not coalesce(price > 50, false)",
)
def _(spark, d):
    root = _folder(spark, "table")
    tables.write_version(fx.messages(spark, d).select("id", "text", "price"), root, 1)
    tables.write_version(ld.delete_where(tables.read_version(spark, root), F.col("price") > 50), root, 2)
    return tables.read_version(spark, root)


WAVES = 2


@register(
    "stream_load_keyed",
    WITH
    + STREAM.format(table="messages")
    + """, stop as (select min(batch_seq) as stop_seq from pages
  where raw_max < timestamp '2024-01-12' or batch_seq = (select max(batch_seq) from pages))
select i.id, i.author_id, i.ts as "createdAt", i.seq as batch_seq from inserted i, stop
where i.ts >= timestamp '2024-01-12' and i.seq <= stop_seq""",
)
def _(spark, d):
    """Pages that arrive in waves, each loaded by the state that earlier ones left; ended by the cutoff."""
    rows = fx.messages(spark, d)
    state = kd.begin(spark, pg.MESSAGES, _folder(spark, "state"), fx.load_target(rows, "createdAt"))
    run = kd.KeyedRun(state, _folder(spark, "run"), "second", datetime(2024, 1, 12))
    paged = tables.stored(_message_feed(fx.overlapping_pages(fx.shown(rows))))
    whole, path = _folder(spark, "whole"), _folder(spark, "pages")
    pg.write_pages(paged, whole, RUN, minutes=True, per_file=fx.PAGES_PER_FILE)
    pages = feeds.read_pages(spark, whole, pg.MESSAGES.row)
    ends = paged.agg(F.min("batch_seq").alias("low"), F.max("batch_seq").alias("high")).first()
    wide = (ends["high"] - ends["low"]) // WAVES + 1
    for at in range(ends["low"], ends["high"] + 1, wide):
        pages.filter(F.col("batch_seq").between(at, at + wide - 1)).write.mode("append").json(path)
        run.load(path, per_trigger=1000)
    loaded = run.loaded()
    return loaded.select("id", F.col("fromUser.id").alias("author_id"), "createdAt", "batch_seq")
