"""Feeds whose records differ, and tables compared by digest."""

import random

import pytest
from pyspark.sql import functions as F

from pagetide.operators import quality as ql
from pagetide.sources import feeds


def test_union_of_record_schemas(spark, tmp_path):
    pages = {
        "1": '[{"id": 1, "text": "a"}, {"id": 2, "who": {"id": 7}}]',
        "2": '[{"id": 3, "who": {"id": 8, "name": "x"}, "price": 1.5, "tags": ["t"]}]',
        "3": '[{"id": 4, "text": ', "4": '{"id": 5}', "5": "[]", "6": "  ", "7": "[1, 2]",
    }
    for name, text in pages.items():
        (tmp_path / f"{name}.json").write_text(text)
    rows, left_out = feeds.read_feed_union(spark, str(tmp_path))
    got = {r["id"]: r for r in rows.collect()}
    assert sorted(got) == [1, 2, 3] and set(rows.columns) == {"id", "text", "who", "price", "tags"}
    assert got[1]["text"] == "a" and got[1]["who"] is None and got[2]["who"]["name"] is None
    assert got[3]["who"]["name"] == "x" and float(got[3]["price"]) == 1.5 and got[3]["tags"] == ["t"]
    assert {(r["file"][-6:-5], r["reason"]) for r in left_out.collect()} >= {
        ("3", "not JSON"), ("4", "not an array of objects"), ("7", "not an array of objects"),
    }


@pytest.mark.parametrize("per_file,files", [(1, 30), (8, 4)])
def test_pages_that_share_a_file(spark, tmp_path, per_file, files):
    rows = spark.range(300).select("id", F.expr("id div 10").alias("batch_seq"), F.when(F.col("id") > 290, "late").alias("note"))
    feeds.write_feed_arrays(rows, str(tmp_path / "pages"), per_file=per_file)
    found, left_out = feeds.read_feed_union(spark, str(tmp_path / "pages" / "*"))
    assert len(found.inputFiles()) == files and left_out.count() == 0
    assert sorted(map(tuple, found.select("id", "note").collect())) == [(i, "late" if i > 290 else None) for i in range(300)]


@pytest.mark.parametrize("bag", [True, False])
def test_parity_by_digest(spark, bag):
    rng = random.Random(2)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "", "a", "b"]), rng.choice([None, 0.5])) for _ in range(200)]
    a = spark.createDataFrame(rows, "x int, y string, z double")
    for other in (rows, rows[::-1], rows[1:], rows + rows[:3], [(9, "n", None), *rows], [], [(r[0], r[2] and "q", r[2]) for r in rows]):
        b = spark.createDataFrame(other, a.schema).repartition(3)
        assert ql.table_parity_by_digest(a, b, bag=bag, buckets=8).first() == ql.table_parity(a, b, bag=bag).first()
    assert ql.table_parity_by_digest(a.limit(0), a.limit(0)).first() == (0, 0)


def test_equal_tables_send_one_row_per_bucket(spark):
    table = spark.range(50_000, numPartitions=2).withColumn("text", F.concat(F.lit("t"), F.col("id").cast("string")))
    sums = ql.digests(table, 16)
    assert sums.count() == 16 and "functions=[partial_count" in sums._jdf.queryExecution().executedPlan().toString()
    assert ql.table_parity_by_digest(table, table.repartition(5), bag=True, buckets=16).first() == (0, 0)
