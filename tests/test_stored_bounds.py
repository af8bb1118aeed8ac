"""Bucketed dimension and bounds from footers: the plain operators' results, by plans that move and read less."""

import random
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pagetide.operators import dimension as dm, load as ld
from pagetide.sources import buckets, footers, layout
from pagetide.sources.tables import stored

DIM = (
    "author_id bigint, media_id bigint, media_duration bigint, media_blob string, seen_count int, "
    "valid_from_ts timestamp_ntz, valid_to_ts timestamp_ntz, is_current boolean, extract_ts timestamp_ntz"
)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def versions(spark, seed, n, hot=0.0):
    rng = random.Random(seed)
    at = datetime(2024, 1, 1)
    rows = []
    for _ in range(n):
        key = (1, 1) if rng.random() < hot else (rng.choice([None, 1, 2, 3]), rng.choice([None, *range(12)]))
        when = at + timedelta(hours=rng.randrange(400))
        rows.append((*key, rng.randrange(3), rng.choice(["a", "b", None]), 1, when, None, True, at + timedelta(days=seed)))
    return spark.createDataFrame(rows, DIM)


@pytest.mark.parametrize("limit,hot", [(5_000_000, 0.0), (60, 0.4)])
def test_bucketed_rebuild_is_the_plain_one(spark, tmp_path, limit, hot):
    dim = stored(dm.versioned(versions(spark, 1, 300, hot).select(*dm.BASE)))
    increment = stored(versions(spark, 2, 60, hot))
    name = "dim_" + uuid.uuid4().hex
    buckets.create(dim, name, str(tmp_path / "dim"), 5)
    assert buckets.bucket_count(spark, name) == 5
    found = buckets.scd2_rebuild(spark, name, increment, limit)
    assert rows_of(found.select(*dm.DIM_COLUMNS)) == rows_of(dm.scd2_rebuild(dim, increment).select(*dm.DIM_COLUMNS))
    old = versions(spark, 3, 20)
    assert rows_of(buckets.history_append(spark, name, old, increment)) == rows_of(dm.history_append(old, dim, increment))


def test_the_bucketed_dimension_is_not_shuffled(spark, tmp_path):
    dim = stored(dm.versioned(versions(spark, 1, 300).select(*dm.BASE)))
    increment = stored(versions(spark, 2, 60))
    name = "dim_" + uuid.uuid4().hex
    buckets.create(dim, name, str(tmp_path / "dim"), 5)
    found = buckets.scd2_rebuild(spark, name, increment)
    plan = found._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    scans = [i for i, x in enumerate(lines) if "Bucketed: true" in x]
    assert len(scans) == 2
    for i in scans:  # from the scan up to its join with the increment's keys
        at, above = depth[i], []
        for k in range(i - 1, -1, -1):
            if depth[k] < at:
                at = depth[k]
                above.append(lines[k])
                if "Join" in lines[k]:
                    break
        assert "SortMergeJoin" in above[-1]
        assert not [x for x in above if "Exchange" in x]


def test_rebuild_of_an_empty_table_and_by_an_empty_increment(spark, tmp_path):
    dim, none = stored(dm.versioned(versions(spark, 1, 40).select(*dm.BASE))), spark.createDataFrame([], DIM)
    for k, (old, new) in enumerate([(dim, none), (none, versions(spark, 2, 9)), (none, none)]):
        name = "dim_" + uuid.uuid4().hex
        buckets.create(old, name, str(tmp_path / f"dim{k}"), 3)
        found = buckets.scd2_rebuild(spark, name, new)
        assert rows_of(found.select(*dm.DIM_COLUMNS)) == rows_of(dm.scd2_rebuild(old, new).select(*dm.DIM_COLUMNS))


@pytest.fixture
def timed(spark, tmp_path):
    at = datetime(2023, 11, 20, 7, 8, 9, 123456)
    rows = [([(f"x{i}", i)], i, i % 4, at + timedelta(days=i)) for i in range(150)] + [([], 900, 1, None)]
    kind = "media array<struct<name: string, id: bigint>>, id bigint, owner bigint, unlockAt timestamp_ntz"
    df = spark.createDataFrame(rows, kind)
    path = str(tmp_path / "table")
    layout.create(footers.with_at(df, "unlockAt"), path, layout.month_of(F.col("unlockAt")), layout.MONTH)
    return df, path


def test_extremes_come_from_footers(spark, timed):
    _, path = timed
    kept = spark.conf.get("spark.sql.sources.useV1SourceList")
    with footers.from_footers(spark):
        plan = footers.extremes(spark, path, F.col("month") > 2023 * 12)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(at_us), MAX(at_us), COUNT(*)]" in plan
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == kept


def test_extremes_need_their_column_in_front(spark, timed, tmp_path):
    df, _ = timed
    late = df.withColumn(footers.AT, footers.at_of(F.col("unlockAt")))
    layout.create(late, str(tmp_path / "late"), layout.month_of(F.col("unlockAt")), layout.MONTH)
    with pytest.raises(ValueError, match="first column"):
        footers.watermark_bounds(spark, str(tmp_path / "late"), None)


@pytest.mark.parametrize(
    "start,end",
    [
        (None, None),
        (datetime(2024, 1, 12, 6), None),
        (datetime(2023, 12, 1), datetime(2024, 2, 29, 23)),
        (datetime(2024, 2, 3), datetime(2024, 2, 9)),
        (datetime(2023, 11, 20, 7, 8, 9, 123456), datetime(2023, 11, 20, 7, 8, 9, 123456)),
        (datetime(2030, 1, 1), None),
        (datetime(2024, 3, 1), datetime(2024, 1, 1)),
    ],
)
def test_window_bounds(spark, timed, start, end):
    df, path = timed
    want = ld.watermark_bounds(df, "unlockAt", start, end, active=False).first().asDict()
    assert footers.watermark_bounds(spark, path, start, end) == want


def test_owner_bounds_as_a_log(spark, timed, tmp_path):
    df, _ = timed
    path, merged = str(tmp_path / "bounds"), str(tmp_path / "merged")
    assert footers.owner_bounds(spark, path).count() == 0
    for batch in (0, 1, 1, 2):  # one is written again
        part = df.filter(F.col("id") % 3 == batch)
        footers.add_owner_bounds(part, F.col("owner"), "unlockAt", path, batch)
    want = rows_of(ld.watermark_lookup(df, "unlockAt", F.col("owner")))
    assert rows_of(footers.owner_bounds(spark, path)) == want
    footers.merge_owner_bounds(spark, path, merged)
    assert rows_of(footers.owner_bounds(spark, merged)) == want
