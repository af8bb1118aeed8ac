"""Row filters of the reports. An empty or missing list means no filter."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from pagetide.functions.scalars import date_lit
from pagetide.plans.skew import parts_of, skew_join

UNKNOWN_ORIGIN = date(1900, 1, 1)


def active_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("expired_ts").isNull())


def only_video(df: DataFrame, duration: str = "duration", include_images: bool = False) -> DataFrame:
    if include_images:
        return df
    return df.filter(F.coalesce(F.col(duration), F.lit(0)) > 0)


def _filter_ids(df: DataFrame, name: str, ids: Iterable | DataFrame | None) -> DataFrame:
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        wanted = ids.select(F.col(ids.columns[0]).cast("bigint").alias(name)).distinct()
        return skew_join(df, wanted, [name], "left_semi")
    ids = [int(i) for i in ids]
    return df.filter(F.col(name).isin(ids)) if ids else df


def filter_authors(df: DataFrame, ids: Iterable | DataFrame | None, name: str = "author_id") -> DataFrame:
    """Keep the given authors; a list is pushed to the scan, a DataFrame is semi-joined."""
    return _filter_ids(df, name, ids)


def filter_item_ids(df: DataFrame, ids: Iterable | DataFrame | None, name: str = "media_id") -> DataFrame:
    return _filter_ids(df, name, ids)


def text_matches(text: Column, substrings: Iterable[str]) -> Column:
    """Any substring occurs, ignoring case; ``%`` and ``_`` act as wildcards."""
    hit = F.lit(False)
    for part in substrings:
        hit = hit | F.ilike(F.coalesce(text, F.lit("")), F.lit(f"%{part}%"))
    return hit


def filter_text_any(
    df: DataFrame, substrings: Iterable[str] | DataFrame | None, name: str = "msg_text"
) -> DataFrame:
    """Rows whose text holds any of the substrings, a list or a table of one column.

    An empty list or table keeps all rows; nulls in a table do not count. A row is kept once
    however many substrings match. A table may be long: see ``matched_texts``.
    """
    if isinstance(substrings, DataFrame):
        parts = substrings.select(F.col(substrings.columns[0]).cast("string").alias("_part"))
        texts = df.select(F.coalesce(F.col(name), F.lit("")).alias("_text")).distinct()
        kept = matched_texts(texts, parts.filter("_part is not null").distinct())
        marked = df.withColumn("_text", F.coalesce(F.col(name), F.lit("")))
        return skew_join(marked, kept, ["_text"], "left_semi").select(*df.columns)
    substrings = list(substrings or [])
    return df.filter(text_matches(F.col(name), substrings)) if substrings else df


#: Letters of the longest gram a substring is looked up by.
GRAM = 3


def _grams(text: Column, n: Column) -> Column:
    """The pieces of ``n`` characters of a text; none if it is shorter."""
    starts = F.sequence(F.lit(1), F.length(text) - n + 1)
    return F.when((n > 0) & (F.length(text) >= n), F.transform(starts, lambda i: F.substring(text, i, n))).otherwise(F.array())


def _patterns(parts: DataFrame) -> DataFrame:
    """_part, _n, _grams, _wild: the grams a text must hold for ``_part`` to match.

    ``_n`` is the length of the grams, GRAM or that of the longest literal run if shorter. A part
    of wildcards alone has ``_n`` 0 and matches texts of ``_wild`` characters or more.
    """
    pattern = F.lower(F.concat(F.lit("%"), F.col("_part"), F.lit("%")))
    literal = r"(?s)((?:[^%_\\]|\\.)+)"  # an escaped character is a literal
    runs = F.transform(F.regexp_extract_all(pattern, F.lit(literal)), lambda r: F.regexp_replace(r, r"(?s)\\(.)", "$1"))
    longest = F.coalesce(F.array_max(F.transform(runs, lambda r: F.length(r))), F.lit(0))
    known = parts.select("_part", runs.alias("_runs"), F.least(longest, F.lit(GRAM)).alias("_n"),
                         F.length(F.regexp_replace(F.regexp_replace(pattern, literal, ""), "%", "")).alias("_wild"))
    grams = F.array_distinct(F.flatten(F.transform("_runs", lambda r: _grams(r, F.col("_n")))))
    return known.select("_part", "_n", "_wild", grams.alias("_grams"))


def matched_texts(texts: DataFrame, parts: DataFrame) -> DataFrame:
    """The rows of distinct ``texts(_text)`` that hold any of distinct ``parts(_part)``, all if there is none.

    An inverted index: every part is looked up by that of its grams which the fewest texts hold,
    and compared only with those texts. Parts with two literal characters or one are looked up by
    that, parts of wildcards alone by length. Texts go to the index by digest; a text itself moves
    once per part that it may hold. Grams that very many texts hold are cut into parts.
    """
    patterns = _patterns(parts)
    # The lengths of grams in use, and the shortest text that passes by length alone.
    sizes = patterns.agg(F.collect_set(F.when(F.col("_n") > 0, F.col("_n"))).alias("sizes")).scalar()
    wild = F.when(F.count(F.lit(1)) == 0, F.lit(0)).otherwise(F.min(F.when(F.col("_n") == 0, F.col("_wild"))))
    free = texts.filter(F.length("_text") >= patterns.agg(wild.alias("least")).scalar())

    digest = F.unhex(F.md5(F.col("_text"))).alias("_digest")
    own = F.flatten(F.transform("_sizes", lambda n: _grams(F.lower("_text"), n)))
    held = texts.withColumn("_sizes", sizes).select(digest, F.explode(F.array_distinct(own)).alias("_gram"))
    wanted = patterns.select("_part", F.explode("_grams").alias("_gram"))
    # How many texts hold each gram of a part; a part with a gram in no text matches none.
    counts = held.join(wanted.select("_gram").distinct(), "_gram", "left_semi").groupBy("_gram").agg(F.count(F.lit(1)).alias("_held"))
    ranked = wanted.join(counts, "_gram", "left").groupBy("_part").agg(
        F.min_by("_gram", F.struct(F.coalesce("_held", F.lit(0)).alias("n"), "_gram")).alias("_gram"),
        F.min(F.coalesce("_held", F.lit(0))).alias("_held"),
    )
    rarest = ranked.filter("_held > 0").select("_gram", "_part")
    hot = counts.select("_gram", parts_of("_held")).toDF("_gram", "_parts").filter("_parts is not null")
    maybe = skew_join(held, rarest, ["_gram"], spread=["_digest"], hot=hot).select("_digest", "_part")
    hit = F.ilike(F.col("_text"), F.concat(F.lit("%"), F.col("_part"), F.lit("%")))
    found = maybe.join(texts.withColumn("_digest", digest), "_digest").filter(hit).select("_text")
    return free.union(found).distinct()


def filter_origin_days(
    df: DataFrame, days: int | None, as_of: date, origin: str = "origin_date"
) -> DataFrame:
    """Origin within ``days`` of ``as_of``; rows without an origin pass."""
    if days is None:
        return df
    return df.filter(F.coalesce(F.col(origin), date_lit(as_of)) >= F.date_sub(date_lit(as_of), days))


def filter_origin_years(
    df: DataFrame, start_year: int | None, end_year: int | None, origin: str = "origin_date"
) -> DataFrame:
    """Origin year from ``end_year`` (older) to ``start_year`` (newer); rows without one fail."""
    if start_year is None and end_year is None:
        return df
    if start_year is None or end_year is None:
        raise ValueError(f"both years of the range are needed: {start_year}, {end_year}")
    year = F.year(F.coalesce(F.col(origin), date_lit(UNKNOWN_ORIGIN)))
    return df.filter(year.between(end_year, start_year))


def filter_origin_min_year(
    df: DataFrame, min_year: int | None, as_of: date | None = None, origin: str = "origin_date"
) -> DataFrame:
    """Origin year at least ``min_year``; with ``as_of``, rows without an origin use its year."""
    if min_year is None:
        return df
    value = F.col(origin) if as_of is None else F.coalesce(F.col(origin), date_lit(as_of))
    return df.filter(F.year(value) >= min_year)
