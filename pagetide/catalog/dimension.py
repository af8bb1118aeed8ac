"""Registered queries: the item dimension, its history and the item-message links."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from pagetide import fixtures as fx, schemas as S
from pagetide.fixtures import FEEDS_SQL
from pagetide.operators import dimension as dm, load as ld, quality as ql
from pagetide.plans.skew import number_versions
from pagetide.sources import buckets, layout
from pagetide.sources.tables import scratch, stored
from pagetide.registry import registry

Q, SQL, register = registry()

RUN_1, RUN_2 = datetime(2024, 1, 20, 12, 30, 15), datetime(2024, 1, 31, 3, 4, 5)
# Eastern wall clock of the two runs.
EASTERN_1, EASTERN_2 = "timestamp '2024-01-20 07:30:15'", "timestamp '2024-01-30 22:04:05'"

WITH = (
    "with "
    + FEEDS_SQL
    + f""",
versions_of as (
  select distinct author_id, media_id, duration as media_duration, blob as media_blob,
    ts as valid_from_ts, ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-20' and id % 7 <> 0 as early
  from message_items),
first_load as (
  select author_id, media_id, media_duration, media_blob, valid_from_ts, {EASTERN_1} as extract_ts
  from versions_of where early),
dim as (
  select *, cast(row_number() over k as integer) as seen_count, lead(valid_from_ts) over k as valid_to_ts,
    lead(valid_from_ts) over k is null as is_current
  from first_load
  window k as (partition by author_id, media_id order by valid_from_ts, extract_ts, media_blob, media_duration)),
ends as (select author_id, min(valid_from_ts) as lo, max(valid_from_ts) as hi from dim group by author_id),
increment as (
  select v.author_id, media_id, media_duration, media_blob, valid_from_ts, {EASTERN_2} as extract_ts
  from versions_of v left join ends using (author_id)
  where lo is null or valid_from_ts < lo or valid_from_ts > hi),
touched as (select distinct author_id, media_id from increment),
rebuilt as (
  select *, cast(row_number() over k as integer) as seen_count, lead(valid_from_ts) over k as valid_to_ts,
    lead(valid_from_ts) over k is null as is_current
  from (
    select author_id, media_id, media_duration, media_blob, valid_from_ts, extract_ts
    from first_load join touched using (author_id, media_id)
    union
    select * from increment)
  window k as (partition by author_id, media_id order by valid_from_ts, extract_ts, media_blob, media_duration)),
new_dim as (
  select * from dim where not exists (
    select 1 from touched t where t.author_id = dim.author_id and t.media_id = dim.media_id)
  union all select * from rebuilt),
history as (select * from dim union all select * from rebuilt)
"""
)
COLUMNS = (
    "author_id, media_id, media_duration, media_blob, seen_count, valid_from_ts, valid_to_ts, "
    "is_current, extract_ts"
)


def _states(spark, d):
    """The dimension after a first load and the increment of a second, as stored tables."""
    messages = fx.messages(spark, d)
    empty = spark.createDataFrame([], S.dim_schema())
    first = dm.dim_increment(fx.load_target(messages, "createdAt"), empty, RUN_1, include_gaps=True)
    # All versions are new: what scd2_rebuild makes of an empty dimension.
    dim = stored(dm.versioned(first.select(*dm.BASE)))
    return dim, stored(dm.dim_increment(messages, dim, RUN_2))


def _first(spark, d):
    return _states(spark, d)[0]


def _history(spark, d):
    dim, increment = _states(spark, d)
    return dm.history_append(dim, dm.scd2_rebuild(dim, increment), increment)


@register(
    "dim_increment",
    WITH
    + """select author_id, media_id, media_duration, media_blob, 1 as seen_count, valid_from_ts,
  cast(null as timestamp) as valid_to_ts, true as is_current, extract_ts from increment""",
)
def _(spark, d):
    return dm.dim_increment(fx.messages(spark, d), _first(spark, d), RUN_2)


@register(
    "dim_increment_with_gaps",
    WITH
    + """select author_id, media_id, valid_from_ts from versions_of
except select author_id, media_id, valid_from_ts from dim""",
)
def _(spark, d):
    new = dm.dim_increment(fx.messages(spark, d), _first(spark, d), RUN_2, include_gaps=True)
    return new.select("author_id", "media_id", "valid_from_ts")


@register("src_distinct", WITH + "select author_id, media_id, media_blob from versions_of group by all")
def _(spark, d):
    rows = dm.message_item_rows(fx.messages(spark, d)).select("author_id", "media_id", "media_blob")
    return dm.src_distinct(rows)


@register("union_distinct", WITH + "select media_id from message_items union select media_id from post_items")
def _(spark, d):
    def ids(df):
        return df.select(F.explode("media.id").alias("media_id"))

    return dm.union_distinct(ids(fx.messages(spark, d)), ids(fx.posts(spark, d)))


@register("scd2_rebuild", WITH + f"select {COLUMNS} from new_dim")
def _(spark, d):
    return dm.scd2_rebuild(*_states(spark, d))


@register("scd2_rebuild_bucketed", WITH + f"select {COLUMNS} from new_dim")
def _(spark, d):
    dim, increment = _states(spark, d)
    path = scratch(spark, "dimension")
    name = "dim_" + path[-12:]
    buckets.create(dim, name, path, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return buckets.scd2_rebuild(spark, name, increment)


@register("version_number", WITH + "select author_id, media_id, valid_from_ts, seen_count from rebuilt")
def _(spark, d):
    return dm.rebuilt_versions(*_states(spark, d)).select(
        "author_id", "media_id", "valid_from_ts", "seen_count"
    )


@register("valid_to", WITH + "select author_id, media_id, valid_from_ts, valid_to_ts from rebuilt")
def _(spark, d):
    return dm.rebuilt_versions(*_states(spark, d)).select(
        "author_id", "media_id", "valid_from_ts", "valid_to_ts"
    )


@register("history_append", WITH + f"select {COLUMNS} from history")
def _(spark, d):
    return _history(spark, d)


@register(
    "history_prune",
    WITH + f"select {COLUMNS} from history where extract_ts in (select max(extract_ts) from history)",
)
def _(spark, d):
    return dm.history_prune(stored(_history(spark, d)), 1)


@register("last_n_runs", WITH + "select distinct extract_ts from history order by 1 desc limit 2")
def _(spark, d):
    return dm.last_n_runs(_history(spark, d), 2)


@register(
    "history_by_run",
    WITH + "select extract_ts, count(*) as n_rows from history group by 1 order by 1 desc limit 15",
)
def _(spark, d):
    return ql.history_by_run(_history(spark, d))


LISTED = "author_id, media_id, seen_count, media_duration, valid_from_ts, valid_to_ts, is_current"


@register(
    "ordered_dim_listing", WITH + f"select {LISTED} from new_dim where media_duration > 0 and seen_count = 1"
)
def _(spark, d):
    return dm.ordered_dim_listing(dm.scd2_rebuild(*_states(spark, d)))


@register(
    "ordered_dim_listing_again",
    WITH + f"select {LISTED} from new_dim where media_duration > 0 and (seen_count > 1 or not is_current)",
)
def _(spark, d):
    return dm.ordered_dim_listing(dm.scd2_rebuild(*_states(spark, d)), first_seen=False)


@register(
    "legacy_last_value",
    WITH
    + """select author_id, media_id, valid_from_ts, last_value(valid_from_ts) over (
  partition by author_id, media_id order by valid_from_ts desc) as last_from_ts from dim""",
)
def _(spark, d):
    return dm.legacy_last_value(_first(spark, d))


LINKS = f""", links as (
  select author_id, media_id, id as chat_id, min(ts) as valid_from_ts, max(expired_ts) as valid_to_ts,
    max(expired_ts) is null as is_current, {EASTERN_2} as extract_ts
  from message_items group by author_id, media_id, id)
"""


@register("item_message_link", WITH + LINKS + "select * from links")
def _(spark, d):
    return dm.item_message_link(fx.messages(spark, d), RUN_2)


@register(
    "overlap_join",
    WITH
    + LINKS
    + """select a.author_id, a.media_id, a.chat_id, count(b.chat_id) as n_open, count(b.chat_id) > 0 as overlaps
from links a left join links b on a.author_id = b.author_id and a.media_id = b.media_id
  and (b.valid_from_ts < a.valid_from_ts or (b.valid_from_ts = a.valid_from_ts and b.chat_id < a.chat_id))
  and coalesce(b.valid_to_ts, timestamp '2024-02-15') > a.valid_from_ts
group by 1, 2, 3""",
)
def _(spark, d):
    return dm.overlap_join(dm.item_message_link(fx.messages(spark, d), RUN_2), datetime(2024, 2, 15))


AWARE = """, aware as (
  select n.*, n.is_current and not exists (
      select 1 from message_items m where m.author_id = n.author_id and m.media_id = n.media_id
        and m.expired_ts is null) as is_deleted,
    md5('{"media_duration":' || media_duration || ',"media_blob":"' || replace(media_blob, '"', '\\"') || '"}') as checksum
  from {dim} n)
"""


@register("dim_delete_aware", WITH + AWARE.replace("{dim}", "new_dim") + f"select {COLUMNS}, is_deleted, checksum from aware")
def _(spark, d):
    return dm.dim_delete_aware(stored(dm.scd2_rebuild(*_states(spark, d))), fx.messages(spark, d))


@register(
    "checksum_change",
    WITH
    + """select author_id, media_id from dim a
where is_current and valid_from_ts < timestamp '2024-01-15' and media_duration > 0""",
)
def _(spark, d):
    """The second table is the first with other durations in the older half."""
    dim, messages = _first(spark, d), fx.messages(spark, d)
    older = F.col("valid_from_ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    changed = dim.withColumn("media_duration", F.when(older, -F.col("media_duration")).otherwise(F.col("media_duration")))
    old, new = dm.dim_delete_aware(dim, messages), dm.dim_delete_aware(changed, messages)
    return dm.checksum_change(old, new).select("author_id", "media_id")


LEGACY = """, src as (
  select * from increment where {known} qualify row_number() over (
    partition by author_id, media_id order by valid_from_ts desc, media_blob) = 1),
merged as (
  select d.author_id, d.media_id, d.valid_from_ts,
    d.seen_count + case when s.valid_from_ts <= d.valid_from_ts then 1 else 0 end as seen_count,
    case when s.valid_from_ts > d.valid_from_ts and d.is_current then s.valid_from_ts else d.valid_to_ts end as valid_to_ts,
    d.is_current and not coalesce(s.valid_from_ts > d.valid_from_ts, false) as is_current
  from dim d left join src s using (author_id, media_id)),
fresh as (
  select * from src s where not exists (
    select 1 from dim d where d.author_id = s.author_id and d.media_id = s.media_id)),
newest as (
  select * from merged qualify row_number() over (
    partition by author_id, media_id order by valid_from_ts desc, seen_count desc) = 1),
added as (
  select s.author_id, s.media_id, s.valid_from_ts,
    case when s.valid_from_ts > n.valid_from_ts then n.seen_count + 1 else 1 end as seen_count,
    case when s.valid_from_ts > n.valid_from_ts then null else n.valid_from_ts end as valid_to_ts,
    s.valid_from_ts > n.valid_from_ts as is_current
  from src s join newest n using (author_id, media_id) where not exists (select 1 from fresh))
select author_id, media_id, valid_from_ts, cast(seen_count as integer) as seen_count, valid_to_ts, is_current from merged
union all select author_id, media_id, valid_from_ts, 1, null, true from fresh
union all select author_id, media_id, valid_from_ts, cast(seen_count as integer), valid_to_ts, is_current from added"""


@register(
    "scd2_merge_legacy",
    WITH
    + LEGACY.replace("{known}", "true"),
)
def _(spark, d):
    dim, increment = _states(spark, d)
    return _merged(dim, stored(increment.transform(_newest_per_key)))


@register("scd2_merge_legacy_known", WITH + LEGACY.replace("{known}", """exists (
    select 1 from dim k where k.author_id = increment.author_id and k.media_id = increment.media_id)"""))
def _(spark, d):
    """Only keys that the dimension has: each source row is added as a version."""
    dim, increment = _states(spark, d)
    return _merged(dim, stored(ld.restrict_to_batch_keys(increment, dim, dm.KEY).transform(_newest_per_key)))


def _merged(dim, source):
    return dm.scd2_merge_legacy(dim, source).select(
        "author_id", "media_id", "valid_from_ts", "seen_count", "valid_to_ts", "is_current"
    )


def _newest_per_key(increment):
    from pagetide.plans.origin import dedup_latest

    return dedup_latest(increment, dm.KEY, F.col("valid_from_ts").desc(), F.col("media_blob"))


# -- the same versioning at volume: parts of orders --------------------------------------


@register(
    "order_part_versions",
    """select o_custkey, l_partkey, o_orderdate, l_quantity,
  row_number() over k as version, lead(o_orderdate) over k as valid_to
from (
  select distinct o_custkey, l_partkey, cast(o_orderdate as timestamp) as o_orderdate, l_quantity
  from orders join lineitem on l_orderkey = o_orderkey)
window k as (partition by o_custkey, l_partkey order by o_orderdate, l_quantity)""",
)
def _(spark, d):
    lines = fx.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = fx.table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate")
    )
    rows = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .select("o_custkey", "l_partkey", "o_orderdate", "l_quantity")
        .distinct()
    )
    return number_versions(
        rows, ["o_custkey", "l_partkey"], "o_orderdate", ["l_quantity"], following="valid_to"
    )


def _stored_history(spark, d):
    """The history as a stored table, one partition per run."""
    path = scratch(spark, "history")
    history = stored(_history(spark, d))
    for run in (RUN_1, RUN_2):
        layout.add_runs(history.filter(F.col("extract_ts") == dm.wall_clock(dm.run_stamp(dm.ts_lit(run)))), path)
    return path


@register("history_by_run_partitioned", WITH + "select extract_ts, count(*) as n_rows from history group by 1")
def _(spark, d):
    runs = layout.runs(spark, _stored_history(spark, d))
    return runs.select(F.timestamp_micros(layout.RUN).cast("timestamp_ntz").alias("extract_ts"), "n_rows")


@register("history_prune_partitioned", SQL["history_prune"])
def _(spark, d):
    path = _stored_history(spark, d)
    layout.prune_runs(spark, path, 1)
    return layout.newest_runs(spark, path, 1).drop(layout.RUN)


def _known(schema):
    """How many values each column of a schema has in the dimension, in SQL."""
    kinds = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    return " union all ".join(f"select '{c}' as column_name, '{k}' as kind, count({c}) as n_known from new_dim" for c, k in kinds)


@register("dim_schema", WITH + _known(S.dim_schema()))
def _(spark, d):
    """The dimension's columns and types, with the number of values in each."""
    schema, dim = S.dim_schema(), dm.scd2_rebuild(*_states(spark, d))
    columns = [
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("kind"), F.count(F.col(f.name).cast(f.dataType)).alias("n_known"))
        for f in schema.fields
    ]
    return dim.agg(F.array(*columns).alias("columns")).select(F.inline("columns"))
