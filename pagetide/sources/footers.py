"""Bounds of a stored table from what its files say of themselves.

The counts and extremes of a column stand in the footers of Parquet files, so an aggregate over
whole files needs no rows. Footers hold usable extremes of whole numbers, not of times: tables
written by ``layout`` may carry the microseconds of their time in the column ``AT``. A filter by
partition keeps this possible, a filter by row does not; a window of time is answered from the
footers of the months inside it and the rows of the two months at its ends.

Bounds of owners, which footers do not tell, are kept in a small table that only grows: each
load adds the bounds of the rows that it inserted.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagetide.functions.scalars import as_ts
from pagetide.sources.layout import MONTH

AT = "at_us"
FOUND = (
    "min_ts timestamp_ntz, max_ts timestamp_ntz, abs_min_ts timestamp_ntz, window_count bigint, total_count bigint"
)
_EPOCH = datetime(1970, 1, 1)
#: Aggregates reach the footers through the newer file source only.
_SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def at_of(ts: Column) -> Column:
    """A time as microseconds since 1970, in the wall time of ``ts``."""
    return F.unix_micros(ts.cast("timestamp"))


def with_at(df: DataFrame, ts: str) -> DataFrame:
    """The rows with ``AT`` in front: Spark looks extremes up by a column's place among the fields,
    which nested columns before it would shift."""
    return df.select(at_of(as_ts(df, ts)).alias(AT), *[c for c in df.columns if c != AT])


def _us(ts: datetime) -> int:
    return (ts - _EPOCH) // timedelta(microseconds=1)


def _ts(us: int | None) -> datetime | None:
    return None if us is None else _EPOCH + timedelta(microseconds=us)


def _month(ts: datetime) -> int:
    return ts.year * 12 + ts.month - 1


@contextmanager
def from_footers(spark: SparkSession) -> Iterator[None]:
    """Settings under which ``extremes`` is answered from footers; as they were afterwards."""
    before = {name: spark.conf.get(name, None) for name in _SETTINGS}
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def extremes(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """month, low, high, n of the months of rows with a time. ``where`` may use the month only.

    Rows without a time have a partition of their own, whose footers hold no extremes.
    """
    table = spark.read.parquet(path).filter(F.col(MONTH).isNotNull())
    if table.columns[0] != AT:
        raise ValueError(f"the first column of {path} is not {AT}")
    table = table if where is None else table.filter(where)
    return table.groupBy(MONTH).agg(F.min(AT).alias("low"), F.max(AT).alias("high"), F.count(F.lit(1)).alias("n"))


def month_bounds(spark: SparkSession, path: str) -> tuple[list, int]:
    """``extremes``, one row per month of a calendar; and the number of rows without a time."""
    with from_footers(spark):
        months = extremes(spark, path).collect()
        return months, spark.read.parquet(path).filter(F.col(MONTH).isNull()).count()


def watermark_bounds(
    spark: SparkSession, path: str, window_start: datetime | None, window_end: datetime | None = None
) -> dict:
    """``load.watermark_bounds`` over all rows of a table by month with the column ``AT``.

    Reads the rows of the months in which the window starts and ends, and footers otherwise.
    """
    start, end = window_start or _EPOCH, window_end
    months, untimed = month_bounds(spark, path)
    edges = {_month(t) for t in (start, end) if t is not None}
    inside = [r for r in months if r[MONTH] > _month(start) and (end is None or r[MONTH] < _month(end))]
    lows, highs = [r["low"] for r in inside], [r["high"] for r in inside]
    count = sum(r["n"] for r in inside)
    at = F.col(AT) >= _us(start)
    at = at if end is None else at & (F.col(AT) <= _us(end))
    # A month whose rows are all outside needs no reading either.
    part = [
        r for r in months
        if r[MONTH] in edges and r["high"] >= _us(start) and (end is None or r["low"] <= _us(end))
    ]
    if part:
        rows = spark.read.parquet(path).filter(F.col(MONTH).isin([r[MONTH] for r in part])).filter(at)
        found = rows.agg(F.min(AT).alias("low"), F.max(AT).alias("high"), F.count(F.lit(1)).alias("n")).first()
        if found["n"]:
            lows.append(found["low"])
            highs.append(found["high"])
            count += found["n"]
    return {
        "min_ts": _ts(min(lows, default=None)),
        "max_ts": _ts(max(highs, default=None)),
        "abs_min_ts": _ts(min((r["low"] for r in months), default=None)),
        "window_count": count,
        "total_count": sum(r["n"] for r in months) + untimed,
    }


# -- bounds of owners --------------------------------------------------------------------

BOUNDS = "owner bigint, low timestamp_ntz, high timestamp_ntz"


def add_owner_bounds(inserted: DataFrame, owner: Column, ts: str, path: str, batch: int) -> None:
    """Log the bounds of a load's rows; a batch that is written again replaces itself."""
    when = as_ts(inserted, ts)
    bounds = inserted.groupBy(owner.cast("bigint").alias("owner")).agg(F.min(when).alias("low"), F.max(when).alias("high"))
    bounds.write.mode("overwrite").parquet(f"{path}/batch={int(batch)}")


def owner_bounds(spark: SparkSession, path: str) -> DataFrame:
    """``load.watermark_lookup`` per owner from the log, by the same names: _owner, _low, _high."""
    try:
        log = spark.read.schema(BOUNDS).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log = spark.createDataFrame([], BOUNDS)
    return log.groupBy(F.col("owner").alias("_owner")).agg(F.min("low").alias("_low"), F.max("high").alias("_high"))


def merge_owner_bounds(spark: SparkSession, path: str, into: str) -> None:
    """Write the log as one batch to the new folder ``into``, where many batches have made it long."""
    bounds = owner_bounds(spark, path).toDF("owner", "low", "high")
    bounds.write.parquet(f"{into}/batch=-1")
