"""Language identification by words first, with backoff to character n-grams.

A word that the model knows is scored by its log frequency in each language. An unseen word
falls back to its character n-grams, the longest that the model knows: five letters, then
four, down to one. A text's scores are the sums over its words; the label is the language
with the highest sum and the score its share after normalisation.

Training counts words on Spark over a sample of labelled rows: at most about ``sample_rows``
of them, chosen by a hash of id and text. That is the only bound: every word and n-gram of the
sample is kept, in every language that has a word there, so the model is bounded by the sample's
text. It is held as sorted 64-bit hashes with a row of 4-byte log rates each. Prediction covers
every text whole.

Defined cases: null texts and texts without a letter are ``und`` with score 0; so is every
text where no labelled row was given. Rows with a null label or text are not learned from.
Ties go to the label that sorts first.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from xxhash import xxh64_intdigest

from pagetide.llm.common import text_of
from pagetide.sources.tables import stored

UNKNOWN = "und"
SAMPLE_ROWS = 20_000
ORDERS = (5, 4, 3, 2, 1)
#: Weight of an n-gram's evidence, as its grams overlap and it says less than a word.
BACKOFF = 0.5
#: Share of a key's mean rate over all languages in its rate in each.
MIXED = 0.01
LETTERS = re.compile(r"[^\W\d_]+")


class Table:
    """Hashes of keys, sorted, with a row of log rates each, one per language."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        self.keys, self.rows = keys, rows

    def find(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``keys`` of those that the table has, and their rows' places."""
        wanted = np.array([*map(hash_of, keys)], np.uint64).view(np.int64)
        at = np.searchsorted(self.keys, wanted)
        known = np.flatnonzero(at < len(self.keys))
        known = known[self.keys[at[known]] == wanted[known]]
        return known, at[known]


def hash_of(key: str) -> int:
    """What ``F.xxhash64`` gives for a string, unsigned."""
    return xxh64_intdigest(key.encode(), 42)


@dataclass
class Model:
    langs: list[str]
    words: Table
    grams: dict[int, Table]  # by order
    scorer: Scorer | None = field(default=None, init=False, repr=False, compare=False)


def _log_rates(counts: DataFrame, langs: list[str]) -> Table:
    """Log of every key's share in each language, mixed with a little of its mean share.

    Shares, unlike counts, do not favour the language with the most text where a key is
    unknown to a language.
    """
    found = counts.select(F.xxhash64("key").alias("key"), "lang", "n").toArrow()
    keys, at = np.unique(found["key"].to_numpy(), return_inverse=True)
    column = np.searchsorted(np.array(langs, object), found["lang"].to_numpy().astype(object))
    rates = np.zeros((len(keys), len(langs)))
    np.add.at(rates, (at, column), found["n"].to_numpy())
    rates /= np.maximum(rates.sum(0), 1)
    rates += MIXED * rates.mean(1, keepdims=True) if langs else 0
    return Table(keys, np.log(rates).astype(np.float32))


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Counts on Spark; what comes to the driver is bounded by the text of ``sample_rows`` rows."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).filter("lang is not null and text is not null")
    n = rows.count()
    scale = 1 << 20
    share = math.ceil(scale * min(1.0, sample_rows / max(n, 1)))
    sample = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(scale)) < share)
    words = (
        sample.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("key"))
        .filter("key <> ''")
        .groupBy("lang", "key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    words = stored(words)  # read once for words and once per order
    langs = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    marked = words.select("lang", F.concat(F.lit("^"), "key", F.lit("$")).alias("w"), "n")
    grams = {}
    for order in ORDERS:
        spots = F.sequence(F.lit(1), F.length("w") - order + 1)
        cut = marked.filter(F.length("w") >= order).select(
            "lang", "n", F.explode(F.transform(spots, lambda i: F.substring("w", i, F.lit(order)))).alias("key")  # noqa: B023
        )
        counts = cut.filter(~F.col("key").isin("^", "$")).groupBy("lang", "key").agg(F.sum("n").alias("n"))
        grams[order] = _log_rates(counts, langs)
    return Model(langs, _log_rates(words, langs), grams)


class Scorer:
    """Scores texts with a model; keeps the scores of the pieces of text it has met."""

    def __init__(self, model: Model, keep: int = 120_000):
        self.model, self.keep = model, keep
        self.words, self.grams = model.words, model.grams
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.rows = np.zeros((0, len(self.model.langs) + 1))

    def score_words(self, words: list[str]) -> np.ndarray:
        """A row of scores per word: known words first, then the longest known n-grams."""
        out = np.zeros((len(words), len(self.model.langs)))
        spots, at = self.words.find(words)
        out[spots] = self.words.rows[at]
        done = set(spots.tolist())
        left = [(i, f"^{w}$") for i, w in enumerate(words) if i not in done]
        for order in ORDERS:
            cut = [(i, w[k : k + order]) for i, w in left for k in range(len(w) - order + 1)]
            if not cut:
                continue
            owner = np.array([i for i, _ in cut])
            found, at = self.grams[order].find([g for _, g in cut])
            if len(found):
                spots, rows = owner[found], self.grams[order].rows[at].astype(float)
                starts = np.flatnonzero(np.r_[True, spots[1:] != spots[:-1]])
                counts = np.diff(np.r_[starts, len(spots)])
                out[spots[starts]] = np.add.reduceat(rows, starts) * (BACKOFF / counts)[:, None]
                done = set(spots.tolist())
                left = [x for x in left if x[0] not in done]
        return out

    def _add(self, pieces: list[str]) -> None:
        """Rows of new pieces of text; the last column is 1 where a piece has a letter."""
        split = [LETTERS.findall(p.lower()) for p in pieces]
        place: dict[str, int] = {}
        flat = [place.setdefault(w, len(place)) for words in split for w in words]
        scores = self.score_words(list(place))
        rows = np.zeros((len(pieces), len(self.model.langs) + 1))
        owner = np.repeat(np.arange(len(pieces)), [len(words) for words in split])
        np.add.at(rows[:, :-1], owner, scores[np.array(flat, np.int64)])
        # Of what the pattern takes for letters, some outside ASCII are numbers.
        rows[:, -1] = [
            bool(words) and (p.isascii() or any(map(str.isalpha, p))) for p, words in zip(pieces, split)
        ]
        self.place.update(zip(pieces, range(len(self.place), len(self.place) + len(pieces))))
        self.rows = np.concatenate([self.rows, rows])

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        split = [t.split() if t else [] for t in texts]
        if len(self.place) > self.keep:
            self.clear()
        new = list(set(chain.from_iterable(split)) - self.place.keys())
        if new:
            self._add(new)
        look = self.place.__getitem__
        return [self._judge(np.fromiter(map(look, pieces), np.int64, len(pieces))) for pieces in split]

    def _judge(self, at: np.ndarray) -> tuple[str, float]:
        total = self.rows[at].sum(0)
        if not total[-1] or not self.model.langs:
            return UNKNOWN, 0.0
        scores = total[:-1]
        best = int(scores.argmax())
        return self.model.langs[best], float(1 / np.exp(scores - scores[best]).sum())


def scorer_of(model: Model) -> Scorer:
    """The scorer of this Python worker, for all its tasks with the model, with which it ends.

    A worker drops a broadcast model when it takes a task of another query.
    """
    if model.scorer is None:
        model.scorer = Scorer(replace(model))  # on a copy, so that the two do not hold each other
    return model.scorer


def predict(spark: SparkSession, model: Model, text: Column) -> Column:
    """struct(lang, score) of each text."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = scorer_of(shared.value)
        for texts in batches:
            found = [
                x for at in range(0, len(texts), 512) for x in scorer.predict(texts.iloc[at : at + 512].tolist())
            ]
            yield pd.DataFrame(found, columns=["lang", "score"])

    return label(text)


def identify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, lang_pred, score of every row."""
    found = predict(docs.sparkSession, model, text_of(text_col))
    return docs.select(F.col(id_col).alias("id"), found.alias("found")).select(
        "id", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")
    )


def held_out(id_col: str) -> Column:
    """The fold that is not learned from: every third row by a checksum of the id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))
