"""Range join by bins and substring look-up by grams: equal to the plain comparison of all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from pagetide.operators import filters as flt
from pagetide.plans import origin as og


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def banded(spark):
    """Items and disjoint bands; a third of the items has one author and the newest, open band."""
    rng = random.Random(1)
    items = [(rng.choice([1, 2, None]), rng.choice([None, *(rng.randrange(-50, 3000) for _ in range(30))]), i) for i in range(900)]
    items += [(7, 10**6 + rng.randrange(200), 900 + i) for i in range(450)]
    bands = [(7, "2025-01-01", 5, og.OPEN_END)]
    for author in (1, 2):
        at = -20
        for day in range(40):
            wide = rng.choice([0, 1, 2, 7, 8, 9, 64, 100, 500])
            bands.append((author, f"2024-01-{day % 28 + 1:02d}", at, at + wide))
            at += wide + rng.choice([0, 0, 3])
        bands.append((author, "2025-01-01", at, og.OPEN_END))
    items = spark.createDataFrame(items, "author_id bigint, media_id bigint, r int")
    bands = spark.createDataFrame(bands, "author_id bigint, posted_date string, first_id bigint, last_id bigint")
    return items, bands.withColumn("posted_date", F.to_date("posted_date"))


def all_pairs(items, bands):
    b = bands.withColumnRenamed("author_id", "b_author")
    on = (items.author_id == b.b_author) & (items.media_id >= b.first_id) & (items.media_id < b.last_id)
    return items.join(b, on, "left").select(*items.columns, F.col("posted_date").alias("origin_date"))


@pytest.mark.parametrize("rows", [20, 5_000_000])
def test_band_join_is_the_range_join(banded, rows):
    items, bands = banded
    found = og.band_join(items, bands, rows)
    assert rows_of(found) == rows_of(all_pairs(items, bands)) and found.count() == items.count()


def test_band_join_of_overlapping_and_of_no_bands(banded):
    items, bands = banded
    twice = bands.union(bands.withColumn("first_id", F.col("first_id") - 3))
    assert rows_of(og.band_join(items, twice)) == rows_of(all_pairs(items, twice))
    none = og.band_join(items, bands.limit(0))
    assert none.filter("origin_date is not null").count() == 0 and none.count() == items.count()


def test_band_join_is_the_lookup(banded):
    items, bands = banded
    keys = items.select("author_id", "media_id").filter("author_id is not null and media_id is not null").distinct()
    assert rows_of(og.band_join(keys, bands, distinct=True)) == rows_of(og.band_lookup(keys, bands))


def test_band_join_spreads_an_author(banded):
    """No join on the author alone, no nested loop, a few bands per bin."""
    items, bands = banded
    plan = plan_of(og.band_join(items, bands))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    joins = [line for line in plan.split("\n") if "Join [" in line]
    assert joins and all("bin" in line or "media_id" in line or "_salt" in line for line in joins if "author_id" in line)
    assert og.binned(bands).groupBy("author_id", "level", "bin").count().agg(F.max("count")).first()[0] <= 2**og.BIN_STEP + 2


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(1)
    rows = [None, "", "a", "ab", "Straße ΣΑΣ", "50% off", "a_b", "x\\y", "new\nline abc"]
    rows += ["".join(rng.choice("abC dé%_") for _ in range(rng.randrange(14))) for _ in range(200)] + ["abc abc"] * 100
    return spark.createDataFrame(list(enumerate(rows)), "id int, msg_text string")


PARTS = [
    ["abc"], ["ab", "b%d"], ["a_b"], ["%"], ["___"], [""], ["a\\%b", "\\_"], ["ΑΣ", "zzz", "C D"], ["é"],
    ["d a", "e%f%a"], ["__________", "zq"], [None, "ba"], ["\\\\"], [None], [],
]


@pytest.mark.parametrize("parts", PARTS, ids=repr)
def test_text_table_is_the_list(spark, texts, parts):
    live = [p for p in parts if p is not None]
    want = texts.filter(flt.text_matches(F.col("msg_text"), live)) if live else texts
    got = flt.filter_text_any(texts, spark.createDataFrame([(p,) for p in parts], "p string"))
    assert got.columns == texts.columns and rows_of(got) == rows_of(want)


def test_many_parts_without_a_nested_loop(spark, texts):
    parts = spark.range(100_000).select(F.concat(F.lit("part "), F.col("id").cast("string")).alias("p"))
    found = flt.filter_text_any(texts.union(spark.createDataFrame([(999, "has PART 77 in it")], texts.schema)), parts)
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)
    assert [r[0] for r in found.collect()] == [999]
