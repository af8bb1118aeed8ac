"""Profiles, grain checks, reconciliation and small lookups."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pagetide.functions.scalars import as_ts, owner_key, round_half_up
from pagetide.plans.origin import distinct_items
from pagetide.plans.skew import following

MIB = 1024.0 * 1024.0


def _stack(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def grain_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and distinct key tuples; equal numbers mean the keys are the grain."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_rows"),
            F.count(F.lit(1)).alias("n_grain"),
        )
    )


def find_dupes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: rows, distinct ids, time range, current rows, distinct items and runs.

    Columns a table lacks give NULL.
    """
    times = ("createdAt", "postedAt", "unlockAt", "valid_from_ts")
    none = F.lit(None).cast("bigint")
    out = []
    for name, df in tables.items():
        have = set(df.columns)
        stamp = next((as_ts(df, t) for t in times if t in have), F.lit(None).cast("timestamp_ntz"))
        totals = df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min(stamp).alias("min_ts"),
            F.max(stamp).alias("max_ts"),
            (F.count_if(F.col("is_current")) if "is_current" in have else none).alias("n_current"),
        )
        # Each column's values are made distinct by themselves: counting several kinds in one
        # aggregate would repeat every row once per column.
        for column, label in (("id", "n_ids"), ("media_id", "n_items"), ("extract_ts", "n_runs")):
            if column in have:
                one = df.select(column).distinct().agg(F.count(column).alias(label))
                totals = totals.join(F.broadcast(one))
            else:
                totals = totals.withColumn(label, none)
        out.append(
            totals.select(
                F.lit(name).alias("table_name"), "n_rows", "n_ids", "min_ts", "max_ts", "n_current", "n_items", "n_runs"
            )
        )
    return _stack(out)


def table_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def history_by_run(history: DataFrame, n: int = 15) -> DataFrame:
    return (
        history.groupBy("extract_ts")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy(F.col("extract_ts").desc_nulls_last())
        .limit(n)
    )


def payload_size(df: DataFrame, columns: Mapping[str, str | None]) -> DataFrame:
    """Length of the JSON text per labelled column (None: the whole row), in characters and MiB."""
    sizes = {
        label: F.sum(F.length(F.to_json(F.struct("*")) if c is None else _json(df, c)))
        for label, c in columns.items()
    }
    return _sizes(df, sizes)


def _json(df: DataFrame, c: str) -> Column:
    kind = df.schema[c].dataType.typeName()
    return F.to_json(c) if kind in ("struct", "array", "map") else F.col(c).cast("string")


def text_size(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Length of the text form per column, in characters and MiB."""
    return _sizes(
        df, {c: F.sum(F.length(F.coalesce(F.col(c).cast("string"), F.lit("")))) for c in columns}
    )


def _sizes(df: DataFrame, sizes: Mapping[str, Column]) -> DataFrame:
    """One scan for all sums, turned into one row per label."""
    sums = df.agg(*[s.cast("bigint").alias(f"s{i}") for i, s in enumerate(sizes.values())])
    pairs = [
        F.struct(F.lit(label).alias("label"), F.coalesce(F.col(f"s{i}"), F.lit(0)).alias("n_chars"))
        for i, label in enumerate(sizes)
    ]
    return sums.select(F.inline(F.array(*pairs))).withColumn(
        "mib", round_half_up(F.col("n_chars") / F.lit(MIB))
    )


def table_stats(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _stack(
        table_count(df).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in tables.items()
    )


def active_expired_counts(
    tables: Mapping[str, tuple[DataFrame, str]], authors: Iterable[int | str]
) -> DataFrame:
    """Active and expired rows of the given authors per table, as {name: (rows, owner column)}."""
    ids = [int(a) for a in authors]
    return _stack(
        df.filter(owner_key(df, owner).isin(ids)).agg(
            F.count_if(F.col("expired_ts").isNull()).alias("active"),
            F.count_if(F.col("expired_ts").isNotNull()).alias("expired"),
        ).select(F.lit(name).alias("table_name"), "*")
        for name, (df, owner) in tables.items()
    )


def table_parity(a: DataFrame, b: DataFrame, exclude: Sequence[str] = (), bag: bool = False) -> DataFrame:
    """Rows only in one of two tables, counted both ways; zero and zero means equal.

    Both sides are grouped by all columns first, so copies shrink before the shuffle and one
    comparison serves both directions. ``bag`` counts repeated rows, as EXCEPT ALL does.
    """
    cols = [c for c in a.columns if c not in exclude]
    one = F.lit(1).cast("bigint")
    both = a.select(*cols, one.alias("_a"), (one * 0).alias("_b")).unionByName(
        b.select(*cols, (one * 0).alias("_a"), one.alias("_b"))
    )
    counts = both.groupBy(*cols).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    if bag:
        left = F.sum(F.greatest(F.col("_a") - F.col("_b"), one * 0))
        right = F.sum(F.greatest(F.col("_b") - F.col("_a"), one * 0))
    else:
        left, right = F.count_if(F.col("_b") == 0), F.count_if(F.col("_a") == 0)
    zero = F.lit(0).cast("bigint")
    return counts.agg(
        F.coalesce(left, zero).alias("only_in_a"), F.coalesce(right, zero).alias("only_in_b")
    )


#: Buckets of a digest comparison; so many rows per side and task at most.
DIGESTS = 4096


def digests(df: DataFrame, buckets: int = DIGESTS) -> DataFrame:
    """_bucket, _n, _d1, _d2: number and digests of the rows in each bucket, in whatever order they come.

    A row's bucket follows from all its columns. The digests are sums of two hashes of a row, so that
    equal bags of rows have equal digests.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    hashed = lambda seed: F.xxhash64(F.lit(seed), *[F.struct(c) for c in cols], *[c.isNull() for c in cols])
    wide = lambda c: F.sum(c.cast("decimal(20,0)"))
    rows = df.select(F.pmod(hashed(0), F.lit(buckets)).alias("_bucket"), hashed(1).alias("_h1"), hashed(2).alias("_h2"))
    return rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"), wide(F.col("_h1")).alias("_d1"), wide(F.col("_h2")).alias("_d2"))


def table_parity_by_digest(
    a: DataFrame, b: DataFrame, exclude: Sequence[str] = (), bag: bool = False, buckets: int = DIGESTS
) -> DataFrame:
    """``table_parity`` that compares rows only in buckets whose digests differ.

    Of equal tables each task sends one row per bucket. Where only the number of copies differs,
    which counts for a bag alone, the rows of those buckets are compared too. Both tables are
    read twice; the list of buckets that differ has ``buckets`` rows at most.
    """
    cols = [c for c in a.columns if c not in exclude]
    a, b = a.select(*cols), b.select(*cols)
    left, right = digests(a, buckets), digests(b, buckets)
    same = [left[c].eqNullSafe(right[c]) for c in ("_n", "_d1", "_d2")]
    differ = left.join(right, left["_bucket"] == right["_bucket"], "full").filter(~(same[0] & same[1] & same[2]))
    differ = differ.select(F.coalesce(left["_bucket"], right["_bucket"]).alias("_bucket"))

    def open_(df: DataFrame) -> DataFrame:
        values = [F.col(f"`{c}`") for c in cols]
        own = F.xxhash64(F.lit(0), *[F.struct(c) for c in values], *[c.isNull() for c in values])
        marked = df.withColumn("_bucket", F.pmod(own, F.lit(buckets)))
        return marked.join(F.broadcast(differ), "_bucket", "left_semi").select(*cols)

    return table_parity(open_(a), open_(b), bag=bag)


# -- item lookups ------------------------------------------------------------------------


def _exploded(messages: DataFrame) -> DataFrame:
    pairs = F.arrays_zip("media.id", "media.duration").cast(
        "array<struct<media_id: bigint, media_duration: bigint>>"
    )
    return messages.select(
        F.col("id").alias("chat_id"),
        owner_key(messages, "fromUser").alias("author_id"),
        F.col("price").alias("msg_price"),
        F.to_date(as_ts(messages, "createdAt")).alias("created_date"),
        F.col("text").alias("msg_text"),
        F.inline(pairs),
    )


def item_lookup(messages: DataFrame, author: int, item: int) -> DataFrame:
    """Every row of an author that holds an item, with price, duration, day and text."""
    holds = F.array_contains(F.col("media.id").cast("array<bigint>"), F.lit(int(item)).cast("bigint"))
    mine = messages.filter((owner_key(messages, "fromUser") == int(author)) & holds)
    return _exploded(mine).filter(F.col("media_id") == int(item))


def item_listing(messages: DataFrame) -> DataFrame:
    """All videos with their message."""
    return _exploded(messages).filter(F.col("media_duration") > 0)


def last_seen_date(messages: DataFrame, author: int | None = None, item: int | None = None) -> DataFrame:
    """Latest message day per (author, item), or of one of them."""
    rows = messages
    if author is not None:
        rows = rows.filter(owner_key(messages, "fromUser") == int(author))
    items = _exploded(rows)
    if item is not None:
        items = items.filter(F.col("media_id") == int(item))
    return items.groupBy("author_id", "media_id").agg(F.max("created_date").alias("last_seen"))


def latest_n(purchases: DataFrame, n: int = 3) -> DataFrame:
    """Newest purchases."""
    return (
        purchases.select(
            "id", "responseType", "unlockSource", as_ts(purchases, "unlockAt").alias("unlockAt"),
            "price", "mediaCount", owner_key(purchases, "author").alias("author_id"),
        )
        .orderBy(F.col("unlockAt").desc_nulls_last(), F.col("id").desc())
        .limit(n)
    )


def top_item_ids(purchases: DataFrame, n: int = 20) -> DataFrame:
    """Highest distinct item ids among the purchases."""
    return distinct_items(purchases).orderBy(F.col("media_id").desc_nulls_last()).limit(n)


def next_item(posts: DataFrame) -> DataFrame:
    """Next higher item id of the author and the time of its post, per item of a post.

    Ids are numbers here, so they order as numbers.
    """
    items = (
        posts.select(
            owner_key(posts, "author").alias("author_id"),
            F.col("id").alias("post_id"),
            as_ts(posts, "postedAt").alias("posted_ts"),
            F.explode(F.col("media.id").cast("array<bigint>")).alias("media_id"),
        )
        .filter(F.col("author_id").isNotNull() & F.col("media_id").isNotNull())
        .withColumn("_here", F.struct("media_id", "posted_ts"))
    )
    return following(
        items, ["author_id"], "media_id", ["posted_ts", "post_id"], "_here", "_next"
    ).select(
        "author_id",
        "post_id",
        "media_id",
        "posted_ts",
        F.col("_next.media_id").alias("next_media_id"),
        F.col("_next.posted_ts").alias("next_media_id_ts"),
    )
