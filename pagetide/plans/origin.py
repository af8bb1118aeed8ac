"""Reports that estimate when an item first appeared.

Posts are dated. The running maximum of the item ids posted so far never falls, so each
posting day owns one range of ids, its band, and the bands of an author do not overlap. An
item's approximate origin is the day whose band holds its id. Items posted under their own
id also get the details of the latest such post.

Both facts depend on (author, item) alone, so they are worked out once per distinct key and
joined to the message rows in one salted join.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from pagetide.functions.scalars import as_ts, date_lit, duration_ratio, item_kind, micros, owner_key
from pagetide.operators import filters as flt
from pagetide.plans.skew import HOT_ROWS, following, parts_of, running_max, salted_join, skew_join
from pagetide.sources.tables import stored, stored_with

OPEN_END = 99_999_999_999
KEY = ["author_id", "media_id"]


# -- rows and items ----------------------------------------------------------------------


def items_total(media: str = "media") -> Column:
    """Total duration of a row's items, without exploding them and from that field alone."""
    durations = F.coalesce(F.col(f"{media}.duration"), F.array()).cast("array<bigint>")
    return F.aggregate(
        durations, F.lit(0).cast("bigint"), lambda total, d: total + F.coalesce(d, F.lit(0).cast("bigint"))
    )


def total_per_row(
    df: DataFrame, key: Iterable[str] = ("id",), media: str = "media", unique: bool = False
) -> DataFrame:
    """Add ``total_duration``: the durations of all items of the rows that share ``key``.

    With ``unique`` keys this is a sum over the row's own array, with no shuffle. Otherwise
    only the keys held by several rows are joined back. Rows with a null key are not pooled.
    """
    key = list(key)
    own = df.withColumn("_own", items_total(media))
    if unique:
        return own.withColumnRenamed("_own", "total_duration")
    # Few ids are held by several rows, and each of those gives one row here.
    shared = (
        own.groupBy(*key)
        .agg(F.sum("_own").alias("_shared"), F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1)
        .select(*key, "_shared")
    )
    return own.join(shared, key, "left").select(
        *df.columns, F.coalesce("_shared", "_own").alias("total_duration")
    )


def message_rows(messages: DataFrame, include_expired: bool = False) -> DataFrame:
    rows = messages if include_expired else flt.active_only(messages)
    ts = as_ts(messages, "createdAt")
    return rows.select(
        F.col("id").alias("row_id"),
        owner_key(messages, "fromUser").alias("author_id"),
        F.col("text").alias("msg_text"),
        F.col("mediaCount").alias("n_media"),
        F.col("price").alias("msg_price"),
        ts.alias("row_ts"),
        F.to_date(ts).alias("row_date"),
        "media",
    ).filter(F.col("author_id").isNotNull())


def purchase_rows(purchases: DataFrame) -> DataFrame:
    ts = as_ts(purchases, "unlockAt")
    return purchases.select(
        F.col("id").alias("row_id"),
        "responseType",
        F.col("unlockSource").alias("ulk_src"),
        owner_key(purchases, "author").alias("author_id"),
        F.col("text").alias("msg_text"),
        F.col("mediaCount").alias("n_media"),
        F.col("price").alias("msg_price"),
        ts.alias("row_ts"),
        F.to_date(ts).alias("row_date"),
        "media",
    ).filter(F.col("author_id").isNotNull())


def post_rows(posts: DataFrame, include_expired: bool = False) -> DataFrame:
    rows = posts if include_expired else flt.active_only(posts)
    ts = as_ts(posts, "postedAt")
    return rows.select(
        F.col("id").alias("post_id"),
        owner_key(posts, "author").alias("author_id"),
        ts.alias("posted_ts"),
        F.to_date(ts).alias("posted_date"),
        F.col("text").alias("wall_text"),
        F.col("price").alias("wall_price"),
        "media",
    ).filter(F.col("author_id").isNotNull())


def explode_items(rows: DataFrame, keep: Iterable[str] | None = None) -> DataFrame:
    """One row per item as ``media_id`` and ``duration``; rows without items vanish."""
    keep = [c for c in (keep or rows.columns) if c != "media"]
    # Zipping the two fields first lets the scan skip the other item fields.
    pairs = F.arrays_zip("media.id", "media.duration").cast(
        "array<struct<media_id: bigint, duration: bigint>>"
    )
    return rows.select(*keep, F.inline(pairs))


# -- running ids, per item ---------------------------------------------------------------

TIME_BITS = 28  # blocks of 2**28 microseconds, about four and a half minutes


def post_items(posts: DataFrame) -> DataFrame:
    """Items of the posts with the post's time as a number, for the ordered scans."""
    items = explode_items(posts, ["author_id", "post_id", "posted_ts", "posted_date"])
    return items.filter(F.col("media_id").isNotNull()).withColumn("_pos", micros("posted_ts"))


def adjusted_ids(items: DataFrame) -> DataFrame:
    """Add the highest id posted so far (``max_id_yet``) and ``adjusted_id``.

    Posts of the same time share the maximum, so the adjusted id of an item, the greater of
    its id and that maximum, always equals the maximum.
    """
    run = running_max(items, ["author_id"], "_pos", F.col("media_id"), "max_id_yet", bits=TIME_BITS)
    return run.withColumn("adjusted_id", F.greatest("media_id", "max_id_yet"))


def next_adjusted(items: DataFrame) -> DataFrame:
    """Add the adjusted id of the author's next item; the last one gets the open end.

    Adjusted ids never fall over time, so ordering by them is ordering by time.
    """
    led = following(
        adjusted_ids(items), ["author_id"], "_pos", ["post_id", "media_id"], "adjusted_id",
        "next_adjusted_id", bits=TIME_BITS,
    )
    return led.withColumn(
        "next_adjusted_id", F.coalesce("next_adjusted_id", F.lit(OPEN_END).cast("bigint"))
    )


# -- bands -------------------------------------------------------------------------------


def day_bands(posts: DataFrame, per_author: bool = True) -> DataFrame:
    """Id range of each posting day: author_id, posted_date, first_id, last_id (exclusive).

    A post's items share one time and hence one running maximum, so the posts are never
    exploded: each gives its highest id and its item count. These collapse to one row per
    author and day on the map side; the running maximum then runs over days, of which an
    author has at most as many as the calendar. Items without an id take no part.

    With ``per_author`` off the running maximum and the next id go over all authors, while
    the bands stay per author and day.
    """
    tops = posts.select(
        "author_id",
        "posted_ts",
        "posted_date",
        F.array_max("media.id").alias("top"),
        F.size(F.array_compact("media.id")).alias("n"),
    ).filter(F.col("top").isNotNull())
    if not per_author:
        return _day_bands_over_all(tops)
    days = tops.groupBy("author_id", "posted_date").agg(
        # Highest id at the earliest time of the day.
        F.min(F.struct(F.col("posted_ts"), (-F.col("top")).alias("neg"))).alias("head"),
        F.max("top").alias("top"),
        F.sum("n").alias("n"),
    )
    by_day = Window.partitionBy("author_id").orderBy(F.col("posted_date").asc_nulls_last())
    earlier = F.max("top").over(by_day.rowsBetween(Window.unboundedPreceding, -1))
    ranged = days.withColumn("earlier", earlier).select(
        "author_id",
        "posted_date",
        F.greatest(-F.col("head.neg"), "earlier").alias("first_id"),
        F.greatest("top", "earlier").alias("day_top"),
        "n",
    )
    open_end = F.lit(OPEN_END).cast("bigint")
    last_day = F.when(F.col("n") > 1, F.greatest("day_top", open_end)).otherwise(open_end)
    return ranged.select(
        "author_id",
        "posted_date",
        "first_id",
        F.coalesce(F.lead("first_id").over(by_day), last_day).alias("last_id"),
    )


def _day_bands_over_all(tops: DataFrame) -> DataFrame:
    """Bands under one running maximum over all authors.

    The posts collapse to one row per time point. The id that follows a time point is the
    running maximum of the next one, which is the same scan run backwards.
    """
    points = tops.withColumn("pos", micros("posted_ts"))
    timeline = points.groupBy("pos").agg(F.max("top").alias("top"), F.sum("n").alias("n")).withColumn(
        "whole", F.lit(0)
    )
    climbing = running_max(timeline, ["whole"], "pos", F.col("top"), "v2", bits=28)
    back = climbing.withColumn("back", -F.col("pos"))
    timed = running_max(
        back, ["whole"], "back", -F.col("v2"), "neg_next", inclusive=False, bits=28
    )
    open_end = F.lit(OPEN_END).cast("bigint")
    # Of the rows at one time, all but the last are followed by the same running maximum.
    end = F.when(F.col("n") > 1, F.greatest("v2", open_end)).otherwise(open_end)
    timed = timed.select("pos", "v2", F.coalesce(-F.col("neg_next"), end).alias("after"))
    return (
        points.select("author_id", "posted_date", "pos")
        .distinct()
        .join(timed, "pos")
        .groupBy("author_id", "posted_date")
        .agg(F.min("v2").alias("first_id"), F.max("after").alias("last_id"))
    )


#: Bins are 2**0, 2**3, 2**6 ... ids wide.
BIN_STEP = 3


def binned(bands: DataFrame) -> DataFrame:
    """Bands by bin: author_id, level, bin, first_id, last_id, posted_date.

    A band goes to the level whose bins are the first at least as wide as itself, and so to one
    or two bins there. Of bands that do not overlap, at most 2**BIN_STEP and two more meet in a bin.
    """
    width = F.log2((F.col("last_id") - F.col("first_id")).cast("double"))
    levels = bands.filter("first_id < last_id").withColumn(
        "level", (F.ceil(width / BIN_STEP) * BIN_STEP).cast("int")
    )
    bins = F.expr("sequence(shiftright(first_id, level), shiftright(last_id - 1, level))")
    return levels.select("author_id", "level", F.explode(bins).alias("bin"), "first_id", "last_id", "posted_date")


def band_join(items: DataFrame, bands: DataFrame, rows: int = HOT_ROWS, distinct: bool = False) -> DataFrame:
    """LEFT range join of items to the bands of their author; adds ``origin_date``.

    Each distinct (author, item) is looked up by an equi join on author and bin, once per level
    that bands have (at most 21, from one aggregated row), and compared with the bands of that
    bin. No task holds an author; a bin with more than ``rows`` items is cut into parts. Bands
    may overlap; an item gets a row for each that holds it. ``band_lookup`` is the form for
    bands that do not overlap. ``distinct`` promises that no key occurs twice in ``items``.
    """
    by_bin = binned(bands)
    levels = by_bin.agg(F.collect_set("level").alias("levels")).scalar()
    keys = items.select(*KEY).filter("author_id is not null and media_id is not null")
    keys = keys if distinct else keys.distinct()
    at_level = keys.select(*KEY, F.explode(levels).alias("level"))
    probes = at_level.withColumn("bin", F.expr("shiftright(media_id, level)"))
    met = skew_join(probes, by_bin, ["author_id", "level", "bin"], spread=["media_id"], rows=rows)
    found = met.filter("media_id >= first_id and media_id < last_id").select(*KEY, F.col("posted_date").alias("origin_date"))
    both = items.join(found, KEY, "left") if distinct else skew_join(items, found, KEY, "left", rows=rows)
    return both.select(*items.columns, "origin_date")


def band_lookup(keys: DataFrame, bands: DataFrame, per_author: bool = True) -> DataFrame:
    """As-of form of ``band_join`` for distinct keys (author_id, media_id).

    The bands of an author are disjoint, so the only candidate is the band that starts last
    at or before the id: the running maximum of (start, end, day) by id over bands and keys
    together. Ids and starts are distinct, so a block of the scan holds at most twice its
    width, whatever the author's share of the keys.

    With ``per_author`` off authors are ignored; the bands must then be those of one author.
    """
    band = "struct<first_id: bigint, last_id: bigint, posted_date: date>"
    starts = bands.filter(F.col("first_id") < F.col("last_id")).select(
        "author_id",
        F.col("first_id").alias("media_id"),
        F.struct("first_id", "last_id", "posted_date").cast(band).alias("_band"),
        F.lit(False).alias("_wanted"),
    )
    points = keys.select("*", F.lit(None).cast(band).alias("_band"), F.lit(True).alias("_wanted"))
    both = points.unionByName(starts, allowMissingColumns=True)
    part = ["author_id"]
    if not per_author:
        both, part = both.withColumn("_whole", F.lit(0)), ["_whole"]
    reached = running_max(both, part, "media_id", F.col("_band"), "_last")
    inside = F.col("media_id") < F.col("_last.last_id")
    return reached.filter("_wanted").select(
        *keys.columns, F.when(inside, F.col("_last.posted_date")).alias("origin_date")
    )


def band_join_unscoped(keys: DataFrame, bands: DataFrame) -> DataFrame:
    """LEFT range join by id alone, for the bands of one author.

    Bands of several authors overlap and would repeat rows, so they are not accepted by the
    reports; as the bands here are disjoint, the as-of form gives the join's rows.
    """
    return band_lookup(keys, bands, per_author=False)


def latest_posts(posts: DataFrame) -> DataFrame:
    """Latest post that holds each (author, item): wall_date, post_id, wall_text, wall_price.

    The row limit of the window is applied before the shuffle too, so an item posted very
    often sends one row per task.
    """
    newest = Window.partitionBy(*KEY).orderBy(
        F.col("posted_ts").desc_nulls_last(), F.col("post_id").desc_nulls_last()
    )
    ids = F.col("media.id").cast("array<bigint>")
    return (
        posts.select(*[c for c in posts.columns if c != "media"], F.explode(ids).alias("media_id"))
        .filter(F.col("media_id").isNotNull())
        .withColumn("_rn", F.row_number().over(newest))
        .filter(F.col("_rn") == 1)
        .select(*KEY, F.col("posted_date").alias("wall_date"), "post_id", "wall_text", "wall_price")
    )


def exact_join(items: DataFrame, posts: DataFrame) -> DataFrame:
    """LEFT equi join of items to the latest post holding them."""
    return skew_join(items, latest_posts(posts), KEY, "left")


def distinct_items(rows: DataFrame, media: str = "media") -> DataFrame:
    return (
        rows.select(F.explode(F.col(f"{media}.id").cast("array<bigint>")).alias("media_id"))
        .filter(F.col("media_id").isNotNull())
        .distinct()
    )


def anti_purchased(items: DataFrame, purchases: DataFrame) -> DataFrame:
    """Drop items bought by anyone; the purchase need not be of the same author."""
    return skew_join(items, distinct_items(purchases), ["media_id"], "left_anti")


def dedup_latest(items: DataFrame, keys: Iterable[str], *order: Column) -> DataFrame:
    """First row per key in the given order; the limit is applied before the shuffle too."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return items.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") == 1).drop("_rn")


# -- reports -----------------------------------------------------------------------------


def _origins(
    items: DataFrame, posts: DataFrame, purchases: DataFrame | None, lookup: str, wall: bool = True
) -> tuple[DataFrame, DataFrame | None]:
    """Per distinct (author, item): origin day and latest post; and the hot keys of the items, if any.

    The keys are stored: the scan over bands, the hot keys and the join read them. Whether any is
    hot is seen as they are written.
    """
    keys = items.groupBy(*KEY).agg(parts_of(F.count(F.lit(1))).alias("_parts"))
    keys, seen = stored_with(keys, hot=F.count("_parts"))
    hot = keys.filter(F.col("_parts").isNotNull()) if seen["hot"] else None
    bands = day_bands(posts)
    found = band_lookup(keys, bands) if lookup == "asof" else band_join(keys, bands, distinct=True)
    if purchases is not None:
        found = found.join(distinct_items(purchases), "media_id", "left_anti")
    return (found.join(latest_posts(posts), KEY, "left") if wall else found), hot


def _with_origins(items: DataFrame, origins: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Items with the origins of their keys. Without a hot key this is a plain join."""
    if hot is None:
        return items.join(origins.drop("_parts"), KEY)
    return salted_join(items, origins, hot, KEY, "inner", spread=["row_id"])


def report_order(df: DataFrame) -> DataFrame:
    """Ratio, then duration, then (where present) unlock date, all descending, NULLs last."""
    order = [F.col("duration_ratio").desc_nulls_last(), F.col("duration").desc_nulls_last()]
    if "unlock_date" in df.columns:
        order.append(F.col("unlock_date").desc_nulls_last())
    return df.orderBy(*order)


def report_ranks(df: DataFrame) -> DataFrame:
    """duration_ratio, duration, place, n: the first place that rows of these values take in the report.

    The order is one of the cluster: rows are sorted in ranges, and a range begins after the rows of
    those before it, of which there is one number each.
    """
    placed = stored(report_order(df).select("duration_ratio", "duration", F.monotonically_increasing_id().alias("at")))
    part = F.shiftright("at", 33)
    ranges = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    at = placed.withColumn("part", part).join(ranges, "part").withColumn("place", F.col("before") + within + 1)
    return at.groupBy("duration_ratio", "duration").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("n"))


def _latest_first() -> list[Column]:
    return [
        F.col("row_date").desc_nulls_last(),
        F.col("row_ts").desc_nulls_last(),
        F.col("duration").desc_nulls_last(),
        F.col("msg_text").desc_nulls_last(),
    ]


def _shown_origin() -> Column:
    return F.coalesce("origin_date", date_lit(flt.UNKNOWN_ORIGIN)).alias("approx_origin_date")


def _ratio() -> Column:
    return duration_ratio("duration", "total_duration").alias("duration_ratio")


def _narrow(
    rows: DataFrame, authors, text_any, item_ids, unique_ids: bool,
    key: Iterable[str] = ("row_id",), include_images: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Items of the wanted rows with their row's total, and the same items' keys alone.

    The author filter goes in front of the totals by hand: they are keyed by row, so
    Catalyst may not push it. The text filter must stay behind them, as rows that share an
    id pool their durations.
    """

    def wanted(rows: DataFrame, keep: Iterable[str] | None = None) -> DataFrame:
        items = explode_items(flt.filter_text_any(rows, text_any), keep)
        items = flt.only_video(items, include_images=include_images)
        return flt.filter_item_ids(items, item_ids).filter(F.col("media_id").isNotNull())

    rows = flt.filter_authors(rows, authors)
    return wanted(total_per_row(rows, key, unique=unique_ids)), wanted(rows, ["author_id"])


def origin_report_messages(
    messages: DataFrame,
    posts: DataFrame,
    purchases: DataFrame,
    *,
    as_of: date,
    authors=None,
    text_any=None,
    item_ids=None,
    last_n_days: int | None = None,
    unique_ids: bool = False,
    lookup: str = "asof",
    ordered: bool = True,
) -> DataFrame:
    """Unbought videos of active messages with their approximate origin.

    One row per (author, item, message). ``unique_ids`` promises that no two messages share
    an id, which saves a shuffle. ``lookup`` is ``asof`` or ``join``.
    """
    out = _messages_base(
        messages, posts, purchases, authors, text_any, item_ids, unique_ids, lookup,
        lambda o: flt.filter_origin_days(o, last_n_days, as_of),
    )
    out = out.select(*_message_columns())
    return report_order(out) if ordered else out


def _message_columns() -> list:
    return [
        "msg_text",
        F.col("row_date").alias("created_date"),
        "media_id",
        F.col("duration").cast("int").alias("duration"),
        "msg_price",
        "n_media",
        _ratio(),
        _shown_origin(),
        "wall_date",
        "wall_price",
        "wall_text",
    ]


def _messages_base(messages, posts, purchases, authors, text_any, item_ids, unique_ids, lookup, keep):
    items, keys = _narrow(message_rows(messages), authors, text_any, item_ids, unique_ids)
    origins, hot = _origins(keys, flt.filter_authors(post_rows(posts), authors), purchases, lookup)
    items = dedup_latest(items, [*KEY, "row_id"], *_latest_first())
    return _with_origins(items, keep(origins), hot)


def origin_by_windows(
    messages: DataFrame,
    posts: DataFrame,
    purchases: DataFrame,
    *,
    as_of: date,
    days: Iterable[int] = (30, 60, 90, 180, 365),
    authors=None,
    unique_ids: bool = False,
    lookup: str = "asof",
    source: str = "messages",
) -> DataFrame:
    """The report once per day window, as ``last_n_days`` next to its columns, in one job.

    Each row is repeated for the windows it falls in; the base report is computed once.
    """
    days = list(days)
    if any(d <= 0 for d in days):
        raise ValueError(f"day windows must be positive: {days}")
    if source == "messages":
        base = origin_report_messages(
            messages, posts, purchases, as_of=as_of, authors=authors,
            unique_ids=unique_ids, lookup=lookup, ordered=False,
        )
    else:
        base = origin_report_purchases(
            purchases, posts, as_of=as_of, authors=authors,
            unique_ids=unique_ids, lookup=lookup, ordered=False,
        )
    unknown = F.col("approx_origin_date") == date_lit(flt.UNKNOWN_ORIGIN)
    age = F.when(unknown, F.lit(0)).otherwise(F.date_diff(date_lit(as_of), "approx_origin_date"))
    windows = F.filter(F.array(*[F.lit(int(d)) for d in days]), lambda d: age <= d)
    return base.select(F.explode(windows).alias("last_n_days"), "*")


def _purchases_base(purchases, posts, authors, text_any, item_ids, unique_ids, lookup, keep, key, images):
    names = {"id": "row_id"}
    items, keys = _narrow(
        purchase_rows(purchases), authors, text_any, item_ids, unique_ids,
        [names.get(k, k) for k in key], images,
    )
    origins, hot = _origins(keys, flt.filter_authors(post_rows(posts), authors), None, lookup)
    items = dedup_latest(items, [*KEY, *[names.get(k, k) for k in key]], *_latest_first(), F.col("ulk_src"))
    return _with_origins(items, keep(origins), hot)


def origin_report_purchases(
    purchases: DataFrame,
    posts: DataFrame,
    *,
    as_of: date,
    authors=None,
    text_any=None,
    item_ids=None,
    last_n_days: int | None = None,
    key: Iterable[str] = ("id",),
    unique_ids: bool = False,
    lookup: str = "asof",
    ordered: bool = True,
) -> DataFrame:
    """Bought videos with their approximate origin, one row per (author, item, purchase).

    Purchase ids are unique per response type only; with the default ``key`` a post and a
    message with one id pool their durations, with ``("responseType", "id")`` they do not.
    """
    out = _purchases_base(
        purchases, posts, authors, text_any, item_ids, unique_ids, lookup,
        lambda o: flt.filter_origin_days(o, last_n_days, as_of), key, False,
    ).select(
        "msg_text",
        F.col("row_date").alias("unlock_date"),
        "ulk_src",
        "media_id",
        F.col("duration").cast("int").alias("duration"),
        "msg_price",
        "n_media",
        _ratio(),
        _shown_origin(),
        "wall_date",
        "wall_price",
        "wall_text",
    )
    return report_order(out) if ordered else out


def origin_report_purchases_images(
    purchases: DataFrame,
    posts: DataFrame,
    *,
    authors=None,
    text_any=None,
    item_ids=None,
    start_year: int | None = None,
    end_year: int | None = None,
    include_images: bool = True,
    key: Iterable[str] = ("id",),
    unique_ids: bool = False,
    lookup: str = "asof",
    ordered: bool = True,
) -> DataFrame:
    """Bought videos and images with their kind, filtered by the years of origin."""
    out = _purchases_base(
        purchases, posts, authors, text_any, item_ids, unique_ids, lookup,
        lambda o: flt.filter_origin_years(o, start_year, end_year), key, include_images,
    ).select(
        "msg_text",
        F.col("row_date").alias("unlock_date"),
        "ulk_src",
        "media_id",
        F.col("duration").cast("int").alias("duration"),
        item_kind("duration").alias("media_kind"),
        "msg_price",
        "n_media",
        _ratio(),
        _shown_origin(),
        "wall_date",
        "wall_price",
        "wall_text",
    )
    return report_order(out) if ordered else out


def origin_report_per_item(
    messages: DataFrame,
    posts: DataFrame,
    *,
    authors=None,
    text_any=None,
    item_ids=None,
    min_year: int | None = None,
    unique_ids: bool = False,
    lookup: str = "asof",
    ordered: bool = True,
) -> DataFrame:
    """Retired form: expired rows count, one row per (author, item), no post details."""
    items, keys = _narrow(
        message_rows(messages, include_expired=True), authors, text_any, item_ids, unique_ids
    )
    rows = flt.filter_authors(post_rows(posts, include_expired=True), authors)
    origins, _ = _origins(keys, rows, None, lookup, wall=False)
    origins = flt.filter_origin_min_year(origins.drop("_parts"), min_year)
    items = dedup_latest(items, KEY, *_latest_first(), F.col("row_id").desc())
    # One row per key on both sides: no key is hot.
    out = items.join(origins, KEY).select(
        "author_id",
        F.col("row_id").alias("chat_id"),
        "msg_text",
        F.col("row_date").alias("created_date"),
        "media_id",
        F.col("duration").cast("int").alias("media_duration"),
        "msg_price",
        F.col("n_media").alias("media_count"),
        _ratio(),
        F.col("origin_date").alias("approx_origin_date"),
    )
    if not ordered:
        return out
    return out.orderBy(
        "author_id", F.col("duration_ratio").desc_nulls_last(), F.col("media_duration").desc_nulls_last()
    )


def origin_report_single_author(
    messages: DataFrame,
    posts: DataFrame,
    author: int,
    *,
    as_of: date,
    min_year: int = 2025,
    unique_ids: bool = False,
    lookup: str = "asof",
    ordered: bool = True,
) -> DataFrame:
    """First form of the report, for the data of one author: bought items stay in.

    Its windows and its range join ignore authors, which is sound for one author only, so
    the author is an argument here.
    """
    out = _messages_base(
        messages, posts, None, [author], None, None, unique_ids, lookup,
        lambda o: flt.filter_origin_min_year(o, min_year, as_of),
    ).select(*[c for c in _message_columns() if not isinstance(c, str) or c != "msg_text"])
    return report_order(out) if ordered else out
