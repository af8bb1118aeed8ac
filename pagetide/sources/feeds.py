"""Reading and writing of feed files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_feed_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of files that each hold one JSON array; fields a row lacks are NULL."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_feed_union(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Rows of files that each hold one JSON array, with the union of their fields; and the files left out.

    The schema of every page is worked out where it is read and merged by an aggregate, so that only
    one schema reaches the driver, and a field that a few rows gained is a column of all. Numbers
    with a fraction are doubles. A file
    that is not a JSON array of objects goes to the second frame: file, value, reason.
    """
    pages = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value").filter(F.trim("value") != "")
    pages = pages.withColumn("page", F.try_parse_json("value"))
    kind = F.schema_of_variant("page")
    fine = F.coalesce(kind.startswith("ARRAY<OBJECT<"), F.lit(False))
    found = pages.filter(fine).agg(F.schema_of_variant_agg("page").alias("schema")).first()["schema"]
    found = found if found is not None and found.startswith("ARRAY<OBJECT<") else "ARRAY<OBJECT<>>"
    schema = re.sub(r"DECIMAL\(\d+,\d+\)", "DOUBLE", found.replace("OBJECT<", "STRUCT<"))
    rows = pages.filter(fine).select(F.inline(F.from_json("value", schema)))
    reason = F.when(F.col("page").isNull(), F.lit("not JSON")).when(~fine, F.lit("not an array of objects"))
    left_out = pages.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select("file", "value", "reason")
    return rows, left_out


def read_feed_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of a replay log with one JSON array per line."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    rows = F.from_json("value", T.ArrayType(schema))
    return lines.select(F.inline(rows))


def write_feed_json(df: DataFrame, path: str, long_as_text: bool = False, mode: str = "errorifexists") -> None:
    """One JSON object per line, NULLs written out; the committer makes the result atomic."""
    out = df
    if long_as_text:
        out = df.select(
            *[
                F.col(f.name).cast("string").alias(f.name)
                if isinstance(f.dataType, T.LongType)
                else F.col(f.name)
                for f in df.schema
            ]
        )
    out.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_feed_log(df: DataFrame, path: str, batch: str = "batch_seq", mode: str = "errorifexists") -> None:
    """Replay log: one line per page, holding the page's rows as a JSON array.

    A page is one response of the feed, some tens of rows, so a line stays small.
    """
    cols = [c for c in df.columns if c != batch]
    lines = df.groupBy(batch).agg(F.to_json(F.collect_list(F.struct(*cols))).alias("value"))
    lines.select("value").write.mode(mode).text(path)


def write_feed_arrays(df: DataFrame, path: str, batch: str = "batch_seq", per_file: int = 1) -> None:
    """One folder per ``per_file`` pages with a file that holds their rows as a JSON array.

    A file is one text to its reader, so it should stay at some megabytes.
    """
    cols = [c for c in df.columns if c != batch]
    pages = df.groupBy(F.expr(f"`{batch}` div {int(per_file)}").alias(batch))
    files = pages.agg(F.to_json(F.collect_list(F.struct(*cols))).alias("value"))
    files.write.partitionBy(batch).text(path)


def read_pages(spark: SparkSession, path: str, row: T.StructType) -> DataFrame:
    """Page files as one row per page."""
    from pagetide.schemas import page_schema

    return spark.read.schema(page_schema(row)).json(path)


def stream_pages(
    spark: SparkSession, path: str, row: T.StructType, per_trigger: int = 1, max_bytes: int | None = None
) -> DataFrame:
    """Page files as a stream, so many files or bytes at a time.

    Files come in modification order; use ``batch_seq`` for order.
    """
    from pagetide.schemas import page_schema

    limit = ("maxFilesPerTrigger", per_trigger) if max_bytes is None else ("maxBytesPerTrigger", int(max_bytes))
    return spark.readStream.schema(page_schema(row)).option(*limit).json(path)
