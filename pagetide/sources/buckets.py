"""The dimension as a bucketed table: its rows lie by key, so joins on the key move only the other side.

A bucketed table is one of the session's catalog, with its files in a folder that the caller
names. Keys with very many versions would make one bucket large work for one task; they are
found in the buckets themselves, without a shuffle, and go the way of ``scd2_rebuild``, which
cuts them into parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pagetide.operators import dimension as dm
from pagetide.operators.load import append
from pagetide.plans.skew import HOT_ROWS, hot_keys
from pagetide.sources.tables import stored_with

KEY = dm.KEY


def create(dim: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """Store a dimension as table ``name`` with its files in ``path``, bucketed and sorted by key.

    Size ``buckets`` so that one fits a task. Each bucket is written by one task, as one file.
    """
    placed = dim.repartition(buckets, *KEY)
    placed.write.bucketBy(buckets, *KEY).sortBy(*KEY).option("path", path).saveAsTable(name)
    return dim.sparkSession.table(name)


def bucket_count(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"describe table extended {name}").filter("col_name = 'Num Buckets'")
    return int(rows.first()["data_type"])


def changed_keys(increment: DataFrame, buckets: int) -> DataFrame:
    """The increment's rows placed as the table's are."""
    return increment.repartition(buckets, *KEY)


def scd2_rebuild(spark: SparkSession, name: str, increment: DataFrame, rows: int = HOT_ROWS) -> DataFrame:
    """``dimension.scd2_rebuild`` on the bucketed table ``name``, which is not shuffled.

    The increment moves to where the keys lie; of the table only the earlier versions of the
    increment's keys move, after the join. Give a stored increment: it is read twice.
    Null keys match nothing, so rows that have one stay as they are and come as new.
    """
    dim = spark.table(name)
    placed = changed_keys(increment, bucket_count(spark, name))
    # A key with more than ``rows`` versions has over half of them on one of the sides.
    many = [hot_keys(side.select(*KEY), KEY, rows // 2).select(*KEY) for side in (dim, placed)]
    hot, seen = stored_with(many[0].union(many[1]).distinct(), n=F.count(F.lit(1)))
    if not seen["n"]:
        return _rebuild(dim, placed)
    cold = _rebuild(_without(dim, hot), _without(placed, hot))
    return append(cold, dm.scd2_rebuild(_among(dim, hot), _among(increment, hot), rows))


def _without(rows: DataFrame, hot: DataFrame) -> DataFrame:
    return rows.join(F.broadcast(hot), KEY, "left_anti")


def _among(rows: DataFrame, hot: DataFrame) -> DataFrame:
    return rows.join(F.broadcast(hot), KEY, "left_semi")


def _rebuild(dim: DataFrame, placed: DataFrame) -> DataFrame:
    touched = placed.select(*KEY).distinct()
    rest = dim.join(touched.hint("shuffle_merge"), KEY, "left_anti")
    old = dim.select(*dm.BASE).join(touched.hint("shuffle_merge"), KEY, "left_semi")
    both = dm.union_distinct(old, placed.select(*dm.BASE))
    return append(rest, dm.numbered(both))


def history_append(spark: SparkSession, name: str, history: DataFrame, increment: DataFrame) -> DataFrame:
    """History plus the rows that the bucketed table holds for the increment's keys."""
    touched = changed_keys(increment, bucket_count(spark, name)).select(*KEY).distinct()
    return append(history, spark.table(name).join(touched.hint("shuffle_merge"), KEY, "left_semi"))
