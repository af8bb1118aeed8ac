"""Quality rules as a short-circuit cascade.

A rule rejects a text or lets it pass; a text is kept if all let it pass, and the first that
rejects it ends its assessment. A sample (about ``sample_rows`` rows, chosen by a hash) tells what
each measure and each rule costs and which rules reject a text together. The cascade takes the
rule with the most rejections per second first, then the one with the most among the texts that
are left, and so on; a measure that an earlier rule has worked out costs nothing more. The order
changes the work and the name of the rule that is reported first, never which texts are kept.

The measures of a text are worked out when a rule first asks for them, so a text that an
early rule rejects never pays for the later ones.

Defined cases: a null text is empty: all measures are 0; it has too few words. Repeated rows
get equal verdicts. With an empty sample the rules run in the order given.
"""

from __future__ import annotations

import math
import re
import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pagetide.llm.common import text_of

SAMPLE_ROWS = 1000
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: White space to str.split, but not to WORD.
OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
SYMBOLS = "#*$%&|<>"


class Text:
    """A text and its measures."""

    def __init__(self, text: str):
        self.text = text

    @cached_property
    def words(self) -> list[str]:
        return WORD.findall(self.text) if OTHER_SPACE.search(self.text) else self.text.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return sum(map(len, self.words))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [x for x in self.text.split("\n") if WORD.search(x)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        w = self.words
        windows = list(zip(w, w[1:], w[2:]))
        if len(set(windows)) == len(windows):
            return 0
        found = Counter(windows)
        covered = bytearray(len(w))
        for i, window in enumerate(windows):
            if found[window] > 1:
                covered[i : i + 3] = b"\x01\x01\x01"
        return sum(covered)

    @cached_property
    def upper_share(self) -> float:
        letters = sum(map(str.isalpha, self.text))
        return sum(map(str.isupper, self.text)) / max(letters, 1)


@dataclass(frozen=True)
class Rule:
    """``uses`` names the attributes of a text that the rule asks for, those they depend on first."""

    name: str
    rejects: Callable[[Text], bool]
    uses: tuple[str, ...] = ()


def too_short(t: Text) -> bool:
    return t.n_words < 50


def repeats_itself(t: Text) -> bool:
    return 100 * t.n_repeat_words > 50 * t.n_words


def symbols(t: Text) -> bool:
    return 10 * t.n_symbols > t.n_words


def shouts(t: Text) -> bool:
    return t.upper_share > 0.5


def same_lines(t: Text) -> bool:
    """Over three tenths of the lines are repeats; a line or two said again is no fault."""
    return t.n_dup_lines > 3 and 10 * t.n_dup_lines > 3 * len(t.lines)


def odd_words(t: Text) -> bool:
    """Words of under two or over twenty characters on average."""
    return not 2 * t.n_words <= t.word_chars <= 20 * t.n_words


BASE = (
    Rule("short", too_short, ("words", "n_words")),
    Rule("repeats", repeats_itself, ("words", "n_words", "n_repeat_words")),
)
RULES = (
    *BASE,
    Rule("symbols", symbols, ("words", "n_words", "n_symbols")),
    Rule("shouting", shouts, ("upper_share",)),
    Rule("lines", same_lines, ("lines", "n_dup_lines")),
    Rule("words", odd_words, ("words", "n_words", "word_chars")),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass
class Sampled:
    """Seconds by measure and rule, and how many texts were rejected by just these rules."""

    seconds: dict[str, float]
    rejected: dict[frozenset, int]


def measure(docs: DataFrame, rules: Sequence[Rule], id_col: str, text_col: str, sample_rows: int) -> Sampled:
    """What the cascade is ordered by. At most ``sample_rows`` or so sets of rules reach the driver."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    scale = 1 << 20
    share = math.ceil(scale * min(1.0, sample_rows / max(docs.count(), 1)))
    steps = list(dict.fromkeys(m for rule in rules for m in rule.uses))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seconds, sets = Counter(), Counter()
        for frame in frames:
            for t in map(Text, frame["text"]):
                for m in steps:
                    start = time.perf_counter()
                    getattr(t, m)
                    seconds["measure " + m] += time.perf_counter() - start
                by = []
                for rule in rules:
                    start = time.perf_counter()
                    if rule.rejects(t):
                        by.append(rule.name)
                    seconds["rule " + rule.name] += time.perf_counter() - start
                sets["\n".join(by)] += 1
        out = [(name, None, took, 0) for name, took in seconds.items()] + [(None, by, 0.0, n) for by, n in sets.items()]
        yield pd.DataFrame(out, columns=["name", "by", "seconds", "n"])

    sample = rows.filter(F.pmod(F.xxhash64("id"), F.lit(scale)) < share)
    found = sample.mapInPandas(run, "name string, by string, seconds double, n bigint")
    found = found.groupBy("name", "by").agg(F.sum("seconds").alias("seconds"), F.sum("n").alias("n")).collect()
    return Sampled(
        {r["name"]: r["seconds"] for r in found if r["name"] is not None},
        {frozenset(r["by"].split("\n")) - {""}: r["n"] for r in found if r["by"] is not None},
    )


def ordered(rules: Sequence[Rule], sampled: Sampled, at_hand: Sequence[str] = ()) -> list[Rule]:
    """The rules, each with the most further rejections per further second; ties keep their order.

    ``at_hand`` are measures that are worked out in any case.
    """
    rest, out, have, left = list(rules), [], set(at_hand), dict(sampled.rejected)

    def worth(rule: Rule) -> float:
        took = sum(sampled.seconds.get("measure " + m, 0.0) for m in rule.uses if m not in have)
        rejected = sum(n for by, n in left.items() if rule.name in by)
        return rejected / max(took + sampled.seconds.get("rule " + rule.name, 0.0), 1e-9)

    while rest:
        best = max(rest, key=worth)
        rest.remove(best)
        out.append(best)
        have.update(best.uses)
        left = {by: n for by, n in left.items() if best.name not in by}
    return out


def assess(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    measures: bool = False,
    first: Sequence[Rule] = (),
) -> DataFrame:
    """id, kept, rejected_by, rules_run of every row; with ``measures`` all measures of all rows too.

    The rules ``first`` are tried before the cascade, on every row, and ``first_failed`` tells
    whether one of them rejects the text; the cascade orders the other rules by the texts that pass
    them. ``rules_run`` is the number of its rules that a text went through.
    """
    first = tuple(first)
    names = {r.name for r in first}
    every = (*first, *(r for r in rules if r.name not in names))
    sampled = measure(docs, every, id_col, text_col, sample_rows)
    sampled.rejected = {by: n for by, n in sampled.rejected.items() if not by & names}
    at_hand = [m for r in first for m in r.uses] + (["words", "lines", *MEASURES] if measures else [])
    cascade = ordered(every[len(first) :], sampled, at_hand)

    def verdict(t: Text) -> tuple[str | None, bool, int]:
        """Who rejects the text, whether that is one of the first rules, and rules of the cascade run."""
        for r in first:
            if r.rejects(t):
                return r.name, True, 0
        for k, r in enumerate(cascade, 1):
            if r.rejects(t):
                return r.name, False, k
        return None, False, len(cascade)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Text(t) for t in batch.column("text").to_pylist()]
            by, numbers = [], {m: [] for m in MEASURES if measures}
            for k, t in enumerate(texts):
                by.append(verdict(t))
                for m, out in numbers.items():
                    out.append(getattr(t, m))
                texts[k] = None  # words take more room than the text
            who, failed, run_of = zip(*by) if by else ((), (), ())
            arrays = [
                batch.column("id"),
                pa.array([n is None for n in who], pa.bool_()),
                pa.array(who, pa.string()),
                pa.array(failed, pa.bool_()),
                pa.array(run_of, pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(
                arrays + [pa.array(x, pa.int64()) for x in numbers.values()],
                names=["id", "kept", "rejected_by", "first_failed", "rules_run", *numbers],
            )

    schema = f"id {docs.schema[id_col].dataType.simpleString()}, kept boolean, rejected_by string, first_failed boolean"
    schema += ", rules_run int" + "".join(f", {m} bigint" for m in MEASURES if measures)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, schema)
