"""Token counts with a cache of counts by content digest.

The cache is a table (digest, version, n_tokens) in a folder that only grows. ``digest`` is
the SHA-256 of a text after normalisation, ``version`` that of the tokenizer file. A run
joins the digests of its texts to the cache, encodes each distinct text that is missing once,
appends those counts and reads all results from the cache.

Normalisation takes away only what this tokenizer's counts cannot depend on: runs of ASCII
white space become one space, and none remains at the ends.

A task that encodes keeps the counts of pieces between white space, up to a bound; a text's
count is the sum over its pieces, since no token and no special string crosses white space.

Defined cases: a null text is an empty one with 0 bytes and tokens; repeated rows and equal
texts are encoded once; an empty table appends nothing. Two runs at the same time may append
the same digest twice: readers take one of the equal counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagetide.llm.bpe import CONTROLS, SPACES
from pagetide.llm.common import join_counted, text_of
from pagetide.sources.tables import scratch, stored

CACHE = "digest binary, version string, n_tokens bigint"


def normalised(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, r"[\t-\r ]+", " "))


def version_of(tokenizer: str) -> str:
    with open(tokenizer, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame | None:
    """Counts of one tokenizer version; None where nothing has been stored."""
    try:
        known = spark.read.schema(CACHE).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return known.filter(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


class Counter:
    """Counts tokens of texts as the library does."""

    def __init__(self, tokenizer: str, keep: int = 400_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.library, self.keep = Tokenizer.from_file(tokenizer), keep
        self.library.no_truncation()
        self.library.no_padding()
        self.known: dict[str, int] = {}

    def batch(self, texts: list[str]) -> list[int]:
        split = [
            [p for p in SPACES.split(t) if p] if CONTROLS.search(t) else t.split() for t in texts
        ]
        if len(self.known) > self.keep:
            self.known.clear()
        new = list(set(chain.from_iterable(split)) - self.known.keys())
        found = self.library.encode_batch_fast(new, add_special_tokens=False)
        self.known.update(zip(new, map(len, found)))
        look = self.known.__getitem__
        return [sum(map(look, pieces)) for pieces in split]


def encode_counts(missing: DataFrame, tokenizer: str, slice_rows: int = 512) -> DataFrame:
    """digest, n_tokens of (digest, text)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter(tokenizer)
        for frame in frames:
            for at in range(0, len(frame), slice_rows):
                part = frame.iloc[at : at + slice_rows]
                yield pd.DataFrame({"digest": part["digest"], "n_tokens": counter.batch(part["text"].tolist())})

    return missing.mapInPandas(run, "digest binary, n_tokens bigint")


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    cache: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, n_bytes, n_tokens of every row. ``cache`` is a folder, by default a new one."""
    spark, version = docs.sparkSession, version_of(tokenizer)
    cache = cache or scratch(spark, "token-counts")
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    digest = F.unhex(F.sha2(normalised(F.col("text")), 256))
    keyed = stored(rows.select("id", F.octet_length("text").cast("bigint").alias("n_bytes"), digest.alias("digest")))
    total = keyed.count()
    spread = F.coalesce(F.col("id").cast("string"), F.lit(""))
    distinct = stored(keyed.groupBy("digest").agg(F.count(F.lit(1)).alias("n")))
    texts = rows.withColumn("digest", digest)
    known = read_cache(spark, cache, version)
    if known is not None:
        # Only texts that are missing travel; with most of them known that is few.
        missing = stored(distinct.join(known, "digest", "left_anti"))
        texts = join_counted(texts, missing, ["digest"], "n", total, spread)
    # Equal texts meet within their task first.
    missing = texts.groupBy("digest").agg(F.any_value("text").alias("text"))
    new = encode_counts(missing, tokenizer)
    new.select("digest", F.lit(version).alias("version"), "n_tokens").write.mode("append").parquet(cache)
    counts = stored(distinct.join(read_cache(spark, cache, version), "digest"))
    return join_counted(keyed, counts, ["digest"], "n", total, spread).select("id", "n_bytes", "n_tokens")
