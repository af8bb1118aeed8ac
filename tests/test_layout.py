"""Partitioned tables: the plain operators' rows, and files of other partitions left as they are."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pagetide.operators import load as ld
from pagetide.sources import layout


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files_by_part(spark, path, name):
    rows = layout.read(spark, path).select(name, F.input_file_name().alias("f")).distinct().collect()
    out = {}
    for value, file in rows:
        out.setdefault(value, set()).add(file)
    return out


@pytest.fixture
def table(spark, tmp_path):
    at = datetime(2023, 11, 20)
    rows = [(i, (i % 5,), f"t{i}", at + timedelta(days=i)) for i in range(120)] + [(500, (1,), "no time", None)]
    df = spark.createDataFrame(rows, "id bigint, author struct<id bigint>, text string, postedAt timestamp_ntz")
    path = str(tmp_path / "table")
    layout.create(df, path, layout.month_of(F.col("postedAt")), layout.MONTH)
    return df, path


def test_replace_keys_rewrites_the_months_of_its_keys(spark, table):
    df, path = table
    before = files_by_part(spark, path, "month")
    moved = datetime(2024, 3, 3)
    changes = spark.createDataFrame(
        [(3, (9,), "changed", moved), (4, (9,), "changed", datetime(2023, 11, 24)), (900, (9,), "new", moved)], df.schema
    )
    n = layout.replace_keys(spark, path, changes, ["id"], layout.month_of(F.col("postedAt")))
    after = files_by_part(spark, path, "month")
    assert rows_of(layout.read(spark, path).select(*df.columns)) == rows_of(ld.replace_keys(df, changes, ["id"]))
    same = {m for m in before if before[m] == after.get(m)}
    assert n == 2 and same == set(before) - {2023 * 12 + 10, 2024 * 12 + 2} and len(same) >= 4


def test_delete_slice_leaves_earlier_months_alone(spark, table):
    df, path = table
    before = files_by_part(spark, path, "month")
    layout.delete_slice(spark, path, "author", 1, "postedAt", date(2024, 2, 10))
    after = files_by_part(spark, path, "month")
    want = ld.delete_slice(df, "author", 1, "postedAt", date(2024, 2, 10))
    assert rows_of(layout.read(spark, path).select(*df.columns)) == rows_of(want)
    assert {m for m in before if before[m] != after.get(m)} == {2024 * 12 + 1, 2024 * 12 + 2}


def test_a_month_without_rows_goes_and_nulls_stay_or_go(spark, table):
    df, path = table
    for author in range(5):
        layout.delete_slice(spark, path, "author", author, "postedAt", date(2024, 1, 1))
    assert {r[0] for r in layout.read(spark, path).select("month").distinct().collect()} == {2023 * 12 + 10, 2023 * 12 + 11, None}
    layout.delete_slice(spark, path, "author", 1, "postedAt")
    left = layout.read(spark, path).select(*df.columns)
    assert rows_of(left) == rows_of(df.filter("author.id <> 1 and postedAt < '2024-01-01'"))
    assert layout.delete_slice(spark, path, "author", 77, "postedAt") == 0


def test_new_rows_by_month_prune_the_scan(spark, table):
    df, path = table
    batch = df.filter("id in (100, 101, 500)").union(
        spark.createDataFrame([(901, (1,), "new", datetime(2024, 2, 1))], df.schema)
    )
    found = layout.new_by_month(batch, layout.read(spark, path), ["id"], "postedAt")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    # A row without a time has no month to be looked up in: it is new.
    assert sorted(r["id"] for r in found.collect()) == [500, 901]


def test_history_by_run(spark, tmp_path):
    path = str(tmp_path / "history")
    stamps = [datetime(2024, 1, d, 5) for d in (1, 2, 3, 4)]
    for k, stamp in enumerate(stamps):
        rows = spark.createDataFrame([(i, stamp) for i in range(k + 1)], "id bigint, extract_ts timestamp_ntz")
        layout.add_runs(rows, path)
        layout.add_runs(rows, path)  # written again, as after a failure
    layout.add_runs(spark.createDataFrame([(99, None)], "id bigint, extract_ts timestamp_ntz"), path)
    assert sorted(r["n_rows"] for r in layout.runs(spark, path).collect()) == [1, 1, 2, 3, 4]
    newest = layout.newest_runs(spark, path, 2)
    assert "PartitionFilters: []" not in newest._jdf.queryExecution().executedPlan().toString()
    assert newest.count() == 3 + 4 + 1
    before = files_by_part(spark, path, "run")
    assert layout.prune_runs(spark, path, 2) == 2
    after = files_by_part(spark, path, "run")
    assert layout.read(spark, path).count() == 8 and all(after[r] == before[r] for r in after)


def test_a_large_month_is_cut_into_parts_of_even_size(spark, tmp_path):
    """No task holds all rows of a month; small months stay one file."""
    rows = spark.range(0, 200_000, 1, 8).select("id", F.xxhash64("id").alias("noise"), F.expr("if(id % 1000 = 0, 7, 8)").alias("m"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "200k")
    try:
        path, runs = str(tmp_path / "table"), str(tmp_path / "runs")
        layout.create(rows.drop("m"), path, F.expr("if(id % 1000 = 0, 7, 8)"), layout.MONTH)
        stamps = rows.select("id", "noise", F.lit("2024-01-01").cast("timestamp_ntz").alias("extract_ts"))
        layout.add_runs(stamps, runs)
        layout.replace_parts(layout.read(spark, path).withColumn("noise", -F.col("noise")), path, layout.MONTH, [7, 8])
    finally:
        spark.conf.unset(size)
    for table, name, part in ((path, layout.MONTH, 8), (runs, layout.RUN, None)):
        files = layout.read(spark, table).groupBy(name, F.input_file_name().alias("f")).count().collect()
        large = [r["count"] for r in files if part is None or r[name] == part]
        assert len(large) >= 4 and max(large) < 60_000
    assert len([r for r in files_by_part(spark, path, "month")[7]]) == 1
    found = layout.read(spark, path).agg(F.count("id").alias("n"), F.sum("id").alias("s"), F.sum(F.col("noise").cast("decimal(38,0)")).alias("t")).first()
    want = rows.agg(F.count("id").alias("n"), F.sum("id").alias("s"), F.sum(-F.col("noise").cast("decimal(38,0)")).alias("t")).first()
    assert found == want
