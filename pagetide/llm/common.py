"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagetide.sources.tables import stored

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_of(col: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased; every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def part_rows(spark: SparkSession, total: int) -> int:
    """Rows above which a group is cut: a quarter of an even share of one shuffle partition."""
    return max(1, -(-total // (4 * parallelism(spark))))


def join_counted(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    count: str,
    total: int,
    spread: Column,
    how: str = "inner",
) -> DataFrame:
    """Equi join with a right side unique in ``keys``, hot keys cut into parts.

    ``count`` is the right side's column with the number of left rows of a key, ``total``
    the number of left rows. Keys above ``part_rows`` are hot. There are at most
    4 * spark.sql.shuffle.partitions of them whatever the input, so their list may be
    broadcast. ``spread`` places a left row in a part; null keys match nothing.
    """
    keys, spark = list(keys), left.sparkSession
    rows = part_rows(spark, total)
    parts = F.ceil(F.col(count) / F.lit(rows)).cast("int")
    hot = right.filter(F.col(count) > rows).select(*keys, parts.alias("_parts"))
    salt = F.pmod(F.xxhash64(spread), F.coalesce("_parts", F.lit(1)).cast("bigint")).cast("int")
    salted = left.join(F.broadcast(hot), keys, "left").withColumn("_salt", salt).drop("_parts")
    many = F.when(F.col(count) > rows, parts).otherwise(1)
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), many - 1)))
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def free_name(columns: Sequence[str], name: str) -> str:
    """``name``, with underscores in front until no column is called so in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def keep_by_verdict(docs: DataFrame, kept: DataFrame, id_col: str, key: Column) -> DataFrame:
    """Rows of ``docs`` whose (id, key of the text) is in ``kept(_id, _key)``.

    All columns stay. A null id matches a null id. ``kept`` may hold a pair repeatedly.
    """
    name_id, name_key = free_name(docs.columns, "_id"), free_name(docs.columns, "_key")
    marked = docs.withColumn(name_id, F.col(id_col)).withColumn(name_key, key)
    right = kept.select(F.col("_id").alias("r_id"), F.col("_key").alias("r_key"))
    match = marked[name_id].eqNullSafe(right["r_id"]) & (marked[name_key] == right["r_key"])
    return marked.join(right, match, "left_semi").select(*docs.columns)


def keep_one(docs: DataFrame, kept: DataFrame, id_col: str, key: Column) -> DataFrame:
    """One row of ``docs`` per (id, key of the text) in ``kept(_id, _key, _n)``.

    ``_n`` is the number of rows that match; a pair is in ``kept`` once. Of rows that differ in
    other columns the one with the smallest hash stays.
    """
    kept = stored(kept)
    once = keep_by_verdict(docs, kept.filter("_n = 1"), id_col, key)
    many = kept.filter("_n > 1")
    if many.isEmpty():
        return once
    mark = lambda i, k: F.sha2(F.concat_ws(":", k, i.cast("string")), 256)
    hashed = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind]
    rows = docs.select(
        mark(F.col(id_col), key).alias("_mark"), F.xxhash64(*hashed).alias("_order"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
    )
    many = stored(many.select(mark(F.col("_id"), F.col("_key")).alias("_mark"), "_n"))
    # Repeats may be a large part of the table: the join is cut, the choice begins in each task.
    found = join_counted(rows, many, ["_mark"], "_n", docs.count(), F.monotonically_increasing_id())
    one = found.groupBy("_mark").agg(F.min_by("_row", "_order").alias("_row")).select("_row.*")
    return once.unionByName(one)
