"""Skew-safe plans give the rows of the plain form, with every key forced to be hot."""

import random

import pytest
from pyspark.sql import Window, functions as F

from pagetide.operators import dimension as dm
from pagetide.plans import origin as og
from pagetide.plans.skew import following, number_versions, running_max, skew_join


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    rows = [(1 if rng.random() < 0.4 else rng.randrange(8), i, rng.randrange(10**9)) for i in range(600)]
    rows += [(None, 9001, 5), (None, 9002, 6)]
    return spark.createDataFrame(rows, "k bigint, id bigint, v bigint")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join(spark, skewed, how):
    right = spark.createDataFrame([(k, f"n{k}") for k in (0, 1, 2, 5, 77)], "k bigint, name string")
    plain = skewed.join(right, "k", how)
    salted = skew_join(skewed, right, ["k"], how, spread=["id"], rows=3)
    assert salted.columns == plain.columns
    assert rows_of(salted) == rows_of(plain)


def test_many_null_keys_spread(spark):
    left = spark.range(100_000).select(F.lit(None).cast("bigint").alias("k"), "id")
    right = spark.createDataFrame([(1, "a")], "k bigint, name string")
    out = skew_join(left, right, ["k"], "left", spread=["id"], rows=3)
    assert out.count() == 100_000 and out.filter("name is not null").count() == 0


@pytest.mark.parametrize("rows", [2, 50, 10**6])
def test_number_versions(spark, rows):
    rng = random.Random(3)
    data = [
        (rng.randrange(3), f"2024-01-{1 + rng.randrange(3):02d} {rng.randrange(24):02d}:{rng.randrange(60):02d}:00", i)
        for i in range(300)
    ] + [(0, None, 999), (0, "1969-12-31 23:57:00", 1000), (0, "1950-01-01 00:00:00", 1001)]
    df = spark.createDataFrame(data, "k int, t string, i int").select(
        "k", F.col("t").cast("timestamp_ntz").alias("t"), "i"
    )
    w = Window.partitionBy("k").orderBy("t", "i")
    plain = df.select("*", F.row_number().over(w).cast("bigint"), F.lead("t").over(w))
    split = number_versions(df, ["k"], "t", ["i"], following="nxt", rows=rows)
    assert rows_of(split.select("k", "t", "i", "version", "nxt")) == rows_of(plain)


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("bits", [1, 4, 40])
def test_running_max(spark, inclusive, bits):
    rng = random.Random(5)
    data = [(rng.randrange(3), rng.randrange(-60, 200), rng.randrange(1000)) for _ in range(200)]
    df = spark.createDataFrame(data, "p int, pos bigint, v bigint")
    w = Window.partitionBy("p").orderBy("pos").rangeBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    plain = df.withColumn("m", F.max("v").over(w))
    assert rows_of(running_max(df, ["p"], "pos", F.col("v"), "m", inclusive, bits)) == rows_of(plain)


@pytest.mark.parametrize("bits", [1, 4, 40])
def test_following(spark, bits):
    rng = random.Random(6)
    data = [(rng.randrange(3), rng.randrange(100), i, rng.randrange(1000)) for i in range(200)]
    df = spark.createDataFrame(data, "p int, pos bigint, i int, v bigint")
    w = Window.partitionBy("p").orderBy("pos", "i")
    plain = df.withColumn("n", F.lead("v").over(w))
    assert rows_of(following(df, ["p"], "pos", ["i"], "v", "n", bits)) == rows_of(plain)


def random_posts(spark, seed, authors=2, n=40, top=300, days=6):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        items = [{"id": rng.randrange(top) if rng.random() > 0.05 else 99_999_999_990 + rng.randrange(30)}
                 for _ in range(rng.randrange(4))]
        ts = f"2024-01-{1 + rng.randrange(days):02d} {rng.randrange(3):02d}:00:00"
        rows.append((i, rng.randrange(authors), ts, items))
    return spark.createDataFrame(
        rows, "post_id bigint, author_id bigint, t string, media array<struct<id: bigint, duration: bigint>>"
    ).select(
        "post_id", "author_id", F.col("t").cast("timestamp_ntz").alias("posted_ts"),
        F.to_date("t").alias("posted_date"), "media",
        F.lit(None).cast("string").alias("wall_text"), F.lit(None).cast("double").alias("wall_price"),
    )


def plain_bands(posts):
    """Bands by windows over single items."""
    items = posts.select("author_id", "posted_ts", "posted_date", F.explode("media.id").alias("id"))
    by_ts = Window.partitionBy("author_id").orderBy("posted_ts")
    top = items.withColumn("top", F.max("id").over(by_ts))
    by_id = Window.partitionBy("author_id").orderBy("top", "posted_ts")
    nxt = top.withColumn("nxt", F.coalesce(F.lead("top").over(by_id), F.lit(og.OPEN_END)))
    return nxt.groupBy("author_id", "posted_date").agg(F.min("top"), F.max("nxt"))


@pytest.mark.parametrize("seed", range(4))
def test_day_bands_and_lookup(spark, seed):
    posts = random_posts(spark, seed)
    bands = og.day_bands(posts)
    assert rows_of(bands) == rows_of(plain_bands(posts))
    keys = spark.createDataFrame(
        [(a, i) for a in range(3) for i in [*range(0, 320, 3), 99_999_999_995, 100_000_000_010, -4]],
        "author_id bigint, media_id bigint",
    )
    assert rows_of(og.band_lookup(keys, bands)) == rows_of(og.band_join(keys, bands))


def test_scd2_with_hot_keys(spark):
    rng = random.Random(11)

    def versions(n, run):
        rows = [
            (1, rng.randrange(3), 10, f"b{rng.randrange(5)}", f"2024-01-0{1 + rng.randrange(5)} 0{rng.randrange(9)}:00:00", run)
            for _ in range(n)
        ]
        return spark.createDataFrame(
            rows, "author_id bigint, media_id bigint, media_duration bigint, media_blob string, f string, x string"
        ).select(
            "author_id", "media_id", "media_duration", "media_blob", F.lit(1).alias("seen_count"),
            F.col("f").cast("timestamp_ntz").alias("valid_from_ts"),
            F.lit(None).cast("timestamp_ntz").alias("valid_to_ts"), F.lit(True).alias("is_current"),
            F.col("x").cast("timestamp_ntz").alias("extract_ts"),
        ).distinct()

    empty = versions(1, "2024-02-01").limit(0)
    first = versions(40, "2024-02-01")
    dim = dm.scd2_rebuild(empty, first)
    second = versions(30, "2024-02-02").filter("media_id < 2")
    plain, hot = dm.scd2_rebuild(dim, second), dm.scd2_rebuild(dim, second, rows=2)
    assert rows_of(plain) == rows_of(hot)
    # One open version per key, closed ones end where the next starts.
    got = {}
    for r in sorted(plain.collect(), key=lambda r: (r.author_id, r.media_id, r.seen_count)):
        got.setdefault((r.author_id, r.media_id), []).append(r)
    for rows in got.values():
        assert [r.seen_count for r in rows] == list(range(1, len(rows) + 1))
        assert [r.is_current for r in rows] == [False] * (len(rows) - 1) + [True]
        assert [r.valid_to_ts for r in rows[:-1]] == [r.valid_from_ts for r in rows[1:]]
    # The order of two increments does not matter.
    swapped = dm.scd2_rebuild(dm.scd2_rebuild(empty, second), first)
    assert rows_of(swapped) == rows_of(plain)
