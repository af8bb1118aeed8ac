"""Shaping of feed rows before they are loaded: column expressions only."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pagetide import schemas as S
from pagetide.functions.scalars import as_ts, parse_ts, ts_lit

BULKY = ("isMarkdownDisabled", "fundRaising", "linkedPosts")
FLAGS = ("convertedToVideo", "canView", "hasError", "isReady", "hasCustomPreview")
MAX_AGE_DAYS = 730


def _item_fields(df: DataFrame, media: str) -> set[str]:
    return {f.name for f in df.schema[media].dataType.elementType.fields}


def trim_items(df: DataFrame, media: str = "media") -> DataFrame:
    """Keep the nine known fields of each item; a missing list becomes an empty one."""
    have = _item_fields(df, media)

    def trimmed(m: Column) -> Column:
        return F.struct(
            *[
                (m[f.name] if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in S.ITEM
            ]
        )

    items = F.transform(media, trimmed)
    return df.withColumn(media, F.coalesce(items, F.array().cast(df.select(items).schema[0].dataType)))


def normalize_items(df: DataFrame, media: str = "media") -> DataFrame:
    """Type the nine fields: flags default to false, duration to 0; a bad id gives NULL."""
    have = _item_fields(df, media)

    def typed(m: Column) -> Column:
        def field(name: str) -> Column:
            return m[name] if name in have else F.lit(None)

        out = []
        for f in S.ITEM:
            value = field(f.name)
            if f.name in FLAGS:
                value = F.coalesce(value.try_cast("boolean"), F.lit(False))
            elif f.name == "duration":
                value = F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint"))
            elif f.name == "id":
                value = value.try_cast("bigint")
            else:
                value = value.cast("string")
            out.append(value.alias(f.name))
        return F.struct(*out)

    return df.withColumn(media, F.transform(media, typed))


def drop_bulky(df: DataFrame, cols: Iterable[str] = BULKY) -> DataFrame:
    return df.drop(*cols)


def select_exclude(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def _text_or_null(df: DataFrame, name: str) -> Column:
    """The column, with '' as missing."""
    if name not in df.columns:
        return F.lit(None).cast("string")
    return F.nullif(F.col(name), F.lit(""))


def _optional(df: DataFrame, name: str, kind: T.DataType) -> Column:
    return (F.col(name) if name in df.columns else F.lit(None)).cast(kind)


def normalize_purchases(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Merge post-shaped and message-shaped purchases into one shape.

    Rows without an id or without any time are dropped. An empty text is kept, while an
    empty time or response type counts as missing.
    """
    posted = _text_or_null(df, "postedAt")
    unlock_at = F.coalesce(posted, _text_or_null(df, "createdAt"))
    kind = F.coalesce(
        _text_or_null(df, "responseType"), F.when(posted.isNotNull(), "post").otherwise("message")
    )
    owner = F.coalesce(*[F.col(c) for c in ("author", "fromUser") if c in df.columns])
    shaped = df.filter(F.col("id").isNotNull() & unlock_at.isNotNull()).select(
        kind.alias("responseType"),
        F.when((kind == "post") | posted.isNotNull(), "wall").otherwise("chat").alias("unlockSource"),
        "id",
        owner.alias("author"),
        F.coalesce(_optional(df, "text", S.STRING), F.lit("")).alias("text"),
        _optional(df, "price", S.DOUBLE).alias("price"),
        _optional(df, "mediaCount", S.INT).alias("mediaCount"),
        _optional(df, "isOpened", S.BOOL).alias("isOpened"),
        _optional(df, "isMediaReady", S.BOOL).alias("isMediaReady"),
        unlock_at.alias("unlockAt"),
        "media",
        *keep,
    )
    return trim_items(shaped)


def in_window(df: DataFrame, ts: str, min_ts: datetime | None) -> DataFrame:
    """Rows with a valid time at or after the cutoff; without a cutoff, all rows."""
    return df if min_ts is None else df.filter(as_ts(df, ts) >= ts_lit(min_ts))


def rolling_cutoff(days: int | None, as_of: datetime) -> datetime:
    """``as_of`` minus ``days``; a missing or non-positive number means two years."""
    return as_of - timedelta(days=days if days is not None and days > 0 else MAX_AGE_DAYS)


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same schema."""
    return df.sparkSession.createDataFrame([], df.schema)


def ensure_columns(df: DataFrame, columns: Mapping[str, str | T.DataType]) -> DataFrame:
    """Add the missing columns as NULL; existing ones stay as they are."""
    missing = {
        name: F.lit(None).cast(kind) for name, kind in columns.items() if name not in df.columns
    }
    return df.withColumns(missing) if missing else df


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the target: missing columns NULL, extra ones dropped, items typed.

    A nested value whose target is text becomes JSON; time text becomes UTC wall time.
    """
    if "media" in df.columns and "media" in schema.fieldNames():
        df = normalize_items(df)
    out = []
    for f in schema:
        if f.name not in df.columns:
            value = F.lit(None).cast(f.dataType)
        else:
            have = df.schema[f.name].dataType
            value = F.col(f.name)
            if isinstance(f.dataType, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
                value = F.to_json(value)
            elif isinstance(f.dataType, T.TimestampNTZType) and isinstance(have, T.StringType):
                value = parse_ts(value)
            elif have != f.dataType:
                value = value.cast(f.dataType)
        out.append(value.alias(f.name))
    return df.select(*out)
