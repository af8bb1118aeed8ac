"""Stored tables laid out so that a change rewrites, and a query reads, only what it concerns.

Feed tables are partitioned by the month of their time, the history by run. A change works out
which partitions it concerns, writes their new contents to the shared folder, and then replaces
just these, by a dynamic partition overwrite; all other partitions keep their files. A partition that
a change leaves empty is removed.

The list of partitions that a change concerns reaches the driver: months of a calendar, or runs.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagetide.functions.scalars import as_ts, owner_key
from pagetide.operators import load as ld
from pagetide.plans.skew import skew_join
from pagetide.sources.tables import _fs, stored

MONTH, RUN = "month", "run"


def month_of(ts: Column) -> Column:
    """Months since the year 0; null without a time."""
    return (F.year(ts) * 12 + F.month(ts) - 1).cast("int")


def run_of(stamp: Column) -> Column:
    """A run's number: its stamp in microseconds."""
    return F.unix_micros(stamp.cast("timestamp")).cast("bigint")


def placed(df: DataFrame, name: str) -> DataFrame:
    """The rows of each partition together; adaptive execution cuts a large one into parts of even size.

    So a partition is few files, and no task holds a whole month or run however many rows that has.
    """
    return df.hint("rebalance", name)


def create(df: DataFrame, path: str, part: Column, name: str) -> None:
    """A new table with ``part`` as its partition column ``name``."""
    placed(df.withColumn(name, part), name).write.partitionBy(name).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _values(parts: DataFrame, name: str) -> list:
    return [r[0] for r in parts.select(name).distinct().collect()]


def _among(name: str, values: Sequence) -> Column:
    """Rows of the partitions: a filter on the partition column, which the scan prunes by."""
    known = F.col(name).isin([v for v in values if v is not None])
    return (known | F.col(name).isNull()) if None in values else known


def replace_parts(new: DataFrame, path: str, name: str, concerned: Sequence) -> None:
    """Give the partitions ``concerned`` the rows of ``new``; they may have been read from the table."""
    spark, new = new.sparkSession, stored(new)
    (
        placed(new, name)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(name)
        .parquet(path)
    )
    for value in set(concerned) - set(_values(new, name)):
        folder, fs = _fs(spark, f"{path}/{name}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")
        fs.delete(folder, True)


def replace_keys(spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str], part: Column, name: str = MONTH) -> int:
    """``load.replace_keys`` on a partitioned table; returns the number of partitions rewritten.

    The partitions of the changed keys are found from the key columns; only those, and the ones the
    changes go to, are read in full.
    """
    table, changes = read(spark, path), stored(changes.withColumn(name, part))
    held = ld.existing_keys(table.select(*keys, name), changes, keys) if name in keys else (
        table.select(*keys, name).join(changes.select(*keys).distinct(), list(keys), "left_semi")
    )
    concerned = sorted(set(_values(held, name)) | set(_values(changes, name)), key=repr)
    if concerned:
        rest = table.filter(_among(name, concerned))
        kept = skew_join(rest, changes.select(*keys).distinct(), keys, "left_anti")
        replace_parts(ld.append(kept.select(*table.columns), changes), path, name, concerned)
    return len(concerned)


def delete_slice(
    spark: SparkSession, path: str, owner_col: str, owner: int, ts: str, from_date: date | None = None
) -> int:
    """``load.delete_slice`` on a table by month; months before ``from_date`` are not read."""
    table = read(spark, path)
    late = table if from_date is None else table.filter(F.col(MONTH) >= from_date.year * 12 + from_date.month - 1)
    gone = owner_key(late, owner_col) == int(owner)
    if from_date is not None:
        gone = gone & (F.to_date(as_ts(late, ts)) >= F.lit(from_date))
    concerned = _values(late.filter(gone), MONTH)
    if concerned:
        rest = table.filter(_among(MONTH, concerned))
        replace_parts(ld.delete_slice(rest, owner_col, owner, ts, from_date), path, MONTH, concerned)
    return len(concerned)


def new_by_month(batch: DataFrame, table: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """``load.batch_scoped_anti`` on a table by month, whose scan is pruned to the batch's months.

    The caller promises that a key keeps its month, as where the time of a row never changes. The
    months are found when the query runs (dynamic partition pruning).
    """
    come = batch.withColumn(MONTH, month_of(as_ts(batch, ts)))
    months = come.select(MONTH).distinct().filter(F.col(MONTH) >= 0)  # at most one row per month of a calendar
    near = table.select(*keys, MONTH).join(F.broadcast(months), MONTH, "left_semi")
    return skew_join(batch, ld.existing_keys(near, come, keys), keys, "left_anti")


# -- history by run ----------------------------------------------------------------------


def add_runs(rows: DataFrame, path: str, stamp: str = "extract_ts") -> None:
    """Add a run's rows to the history; a run that is written again replaces itself."""
    rows = rows.withColumn(RUN, run_of(F.col(stamp)))
    placed(rows, RUN).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN).parquet(path)


def runs(spark: SparkSession, path: str) -> DataFrame:
    """Number of rows of each run, from partition values and row counts: no column is read."""
    return read(spark, path).groupBy(RUN).agg(F.count(F.lit(1)).alias("n_rows"))


def newest_runs(spark: SparkSession, path: str, n: int) -> DataFrame:
    """History of the newest ``n`` runs and of rows without a stamp; other partitions are not read."""
    kept = [r[RUN] for r in runs(spark, path).filter(F.col(RUN).isNotNull()).orderBy(F.col(RUN).desc()).limit(n).collect()]
    return read(spark, path).filter(_among(RUN, [*kept, None]))


def prune_runs(spark: SparkSession, path: str, n: int) -> int:
    """Remove the partitions of all but the newest ``n`` runs; nothing is rewritten."""
    stamps = sorted((r[RUN] for r in runs(spark, path).collect() if r[RUN] is not None), reverse=True)
    for run in stamps[n:]:
        folder, fs = _fs(spark, f"{path}/{RUN}={run}")
        fs.delete(folder, True)
    return len(stamps[n:])
