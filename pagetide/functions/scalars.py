"""Scalar expressions shared by the operators."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

ZONED = r"(Z|[+-]\d{2}:?\d{2})$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(value: datetime | str) -> Column:
    """A zone-free timestamp literal (UTC wall time)."""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def date_lit(value: date | str) -> Column:
    return F.lit(str(value)).cast("date")


def instant_to_utc(c: Column) -> Column:
    """UTC wall time of an instant, whatever the session time zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), ts_lit("1970-01-01 00:00:00"))


def parse_ts(c: Column | str) -> Column:
    """ISO text to UTC wall time; text that is no timestamp gives NULL.

    Text with an offset is an instant and is converted; text without one is UTC already.
    """
    c = col(c)
    return F.when(c.rlike(ZONED), instant_to_utc(c.try_cast("timestamp"))).otherwise(
        c.try_cast("timestamp_ntz")
    )


def as_ts(df: DataFrame, name: str) -> Column:
    """The column as UTC wall time; columns that already are stay bare for pushdown."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.col(name)
    if isinstance(kind, T.TimestampType):
        return instant_to_utc(F.col(name))
    return parse_ts(name)


def wall_clock(c: Column, zone: str = "US/Eastern") -> Column:
    """Wall time in ``zone`` of a UTC wall time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), c)


def micros(c: Column | str) -> Column:
    """Microseconds since 1970 of a zone-free timestamp."""
    c = col(c)
    seconds = F.unix_date(F.to_date(c)).cast("bigint") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
    return seconds * 1000000 + (F.extract(F.lit("SECOND"), c) * 1000000).cast("bigint")


def run_stamp(c: Column) -> Column:
    """Whole seconds, as run times are stored."""
    fraction = F.extract(F.lit("SECOND"), c) % 1
    return F.timestamp_add("MICROSECOND", -(fraction * 1000000).cast("bigint"), c)


def round_half_up(c: Column, digits: int = 2) -> Column:
    """Rounding of non-negative doubles by their binary value (29/200 gives 0.14)."""
    scale = float(10**digits)
    return F.floor(c * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def duration_ratio(duration: Column | str, total: Column | str) -> Column:
    """Share of an item in its row's total; NULL where the total is zero."""
    return round_half_up(
        F.try_divide(col(duration).cast("double"), col(total).cast("double"))
    )


def item_kind(duration: Column | str) -> Column:
    return F.when(F.coalesce(col(duration), F.lit(0)) > 0, F.lit("video")).otherwise(F.lit("image"))


def digits_id(c: Column | str) -> Column:
    """Digits of a text id as BIGINT; none, or too many, gives NULL."""
    digits = F.regexp_replace(col(c).cast("string"), r"\D", "")
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def numeric_id(df: DataFrame, name: str) -> Column:
    """``digits_id`` of a column; a whole number that is not negative is its own digits."""
    if not isinstance(df.schema[name].dataType, (T.LongType, T.IntegerType)):
        return digits_id(name)
    value = F.col(name).cast("bigint")
    return F.when(value >= 0, value).otherwise(digits_id(name))


def author_from_url(c: Column | str) -> Column:
    """Author id in a ``/chat/<id>`` URL, else in a trailing ``/<id>`` path part."""
    c = col(c)

    def first_group(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))

    return F.coalesce(first_group(r"/chat/(\d+)"), first_group(r"/(\d+)/?$"))


def owner_id(df: DataFrame, name: str) -> Column:
    """Owner id as text, from a struct column or from JSON text."""
    if isinstance(df.schema[name].dataType, T.StructType):
        return F.col(f"{name}.id").cast("string")
    return F.get_json_object(F.col(name), "$.id")


def owner_key(df: DataFrame, name: str) -> Column:
    """Owner id as BIGINT, the form joins and windows use."""
    if isinstance(df.schema[name].dataType, T.StructType):
        return F.col(f"{name}.id").cast("bigint")
    return F.get_json_object(F.col(name), "$.id").try_cast("bigint")


def multi_extract(blob: Column | str, fields: str) -> Column:
    """Several JSON fields in one parse, as a struct, e.g. ``"id BIGINT, duration BIGINT"``."""
    return F.from_json(col(blob), fields)
