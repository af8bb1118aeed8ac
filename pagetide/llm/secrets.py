"""Secrets in texts: fixed patterns, and a battery of randomness tests for the rest.

Only DataFrame functions are used. Fixed patterns give spans of known forms (``BASE``). Any
other long token is judged by how random it looks. Its encoding is inferred (hexadecimal,
base 32, letters and digits, base 64, base 64 for URLs), padding is set aside, each character
becomes its place in that alphabet, and five tests give p-values under the assumption of
independent, uniform characters:

* chi-squared of the counts of 16 classes of characters, each against its number of symbols,
* chi-squared of the counts of upper case, lower case and other characters,
* the chance that those of the three which are absent are absent,
* the number of runs above and below the middle of the alphabet,
* the serial correlation of neighbouring characters.

A token's value is the smallest of the five, times five. Words and structured names fail at
least one of the tests, the more surely the longer they are. Over the whole corpus, tokens are
put into classes by length, and in each class the procedure of Benjamini and Hochberg at
``level / number of classes`` decides which tokens are not random; it runs on counts per class
and p-value step, a table of fixed size. What it does not reject is reported. So a random key is
missed with a probability of at most ``level / number of classes`` or so, whatever its length,
while a token that is not random is reported where it is too short to tell. Two rules keep such
tokens few: one must have about as many different characters as chance would give, and one of
fewer than ``SHORT`` characters must not be of one case or digits alone, as a word in capitals
or a number is.

Defined cases: a null text is empty and has no span; repeated rows are counted as often as they
occur; overlapping spans of different kinds are all reported, except that a random token
inside or across a span of a fixed pattern is not reported again.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from pagetide.llm.common import text_of

#: Kind, pattern (Java syntax; letters of the names in either ASCII case),
#: group whose length counts, its least length. The order is that of kinds at one start.
BASE = [
    ("assign", r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    # Runs of one class of characters: a run that is too short has no longer part, so the
    # least length may stand in the pattern.
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
]
KINDS = ["assign", "access", "hex", "random"]
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,6}"
UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encodings as (pattern of a whole token without padding, alphabet); the first that fits is taken.
ENCODINGS = [
    ("^[0-9a-f]+$", DIGITS + "abcdef"),
    ("^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("^[A-Z2-7]+$", UPPER + "234567"),
    ("^[A-Za-z0-9]+$", DIGITS + UPPER + LOWER),
    ("^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
    ("^.*$", UPPER + LOWER + DIGITS + "+/-_"),
]
#: A shorter token must have characters of two cases, or of one and others.
SHORT = 32
CLASSES = 16
#: Lower ends of the classes of length.
LENGTHS = (20, 24, 32, 40, 64, 128)
STEPS = 60  # p-values are counted in steps of a factor 10**(1/5) down to 1e-12
LEVEL = 0.01


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, wherever and how often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(lengths: Column, block: int = 256) -> Column:
    """Sums of the elements before each one.

    In two levels, since an array grows by copying: sums within blocks, then blocks.
    """
    def grow(parts: Column, start: Column) -> Column:
        init = F.struct(start.alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(
            parts, init,
            lambda acc, x: F.struct(
                (acc["at"] + x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")
            ),
        )

    spots = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(lengths) / F.lit(block)).cast("int") - 1, F.lit(0)))
    blocks = F.transform(spots, lambda i: F.slice(lengths, i * block + 1, F.lit(block)))
    init = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<array<bigint>>").alias("out"))

    def add(acc: Column, part: Column) -> Column:
        done = grow(part, acc["at"])
        return F.struct(done["at"].alias("at"), F.array_append(acc["out"], done["out"]).alias("out"))

    return F.flatten(F.aggregate(blocks, init, add)["out"])


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<at, to, length>> of all matches in order, by code points from 0.

    ``length`` is that of the group. The pieces between matches, as split by the same
    pattern, tell where the matches are.
    """
    whole = F.lit(f"({pattern})")
    found = F.regexp_extract_all(text, whole, F.lit(1))
    of_group = F.regexp_extract_all(text, whole, F.lit(1 + group)) if group else found
    gaps = F.transform(F.split(text, pattern, -1), lambda gap: F.length(gap))

    def spans(x: Column) -> Column:
        ends = _running(F.zip_with(x["gaps"], x["sizes"], lambda g, m: F.coalesce(g + m, F.lit(0)).cast("bigint")))
        return let(
            ends,
            lambda e: F.transform(
                x["sizes"],
                lambda m, i: F.struct(
                    (F.get(e, i) + F.get(x["gaps"], i)).alias("at"),
                    (F.get(e, i) + F.get(x["gaps"], i) + m).alias("to"),
                    F.get(x["groups"], i).alias("length"),
                ),
            ),
        )

    sizes = F.transform(found, lambda m: F.length(m))
    groups = F.transform(of_group, lambda m: F.length(m))
    return F.when(
        F.rlike(text, F.lit(pattern)),
        let(F.struct(gaps.alias("gaps"), sizes.alias("sizes"), groups.alias("groups")), spans),
    ).otherwise(F.array().cast("array<struct<at:bigint,to:bigint,length:int>>"))


def _normal_tail(z: Column) -> Column:
    """Two-sided tail of the normal distribution, by Abramowitz and Stegun 7.1.26."""
    x = F.abs(z) / math.sqrt(2)
    t = F.lit(1.0) / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.least(F.lit(1.0), poly * F.exp(-x * x))


def _shares(alphabet: str) -> Column:
    """An alphabet with the shares of its symbols in the classes and in the three cases."""
    n = len(alphabet)
    place = [(i * 2 + 1) * CLASSES // (2 * n) for i in range(n)]
    kinds = [sum(c in UPPER for c in alphabet), sum(c in LOWER for c in alphabet)]
    kinds.append(n - sum(kinds))
    return F.struct(
        F.lit(alphabet).alias("letters"),
        F.array(*[F.lit(place.count(k) / n) for k in range(CLASSES)]).alias("classes"),
        F.array(*[F.lit(k / n) for k in kinds]).alias("kinds"),
    )


def battery(token: Column) -> Column:
    """struct(p, distinct, cases): the combined p-value, the number of different characters and
    how many of upper case, lower case and others occur."""
    body = F.regexp_replace(token, "=+$", "")
    return let(body, _judge)


def _judge(token: Column) -> Column:
    which = F.lit(len(ENCODINGS) - 1)
    for k in range(len(ENCODINGS) - 2, -1, -1):
        which = F.when(token.rlike(ENCODINGS[k][0]), F.lit(k)).otherwise(which)
    encoding = F.get(F.array(*[_shares(alphabet) for _, alphabet in ENCODINGS]), which)
    chars = F.filter(F.split(token, ""), lambda c: c != "")
    # Places of the characters, scaled to the open interval from 0 to 1.
    places = lambda e: F.transform(chars, lambda c: (F.instr(e["letters"], c) - 0.5) / F.length(e["letters"]))
    upper, lower = (F.length(F.regexp_replace(token, f"[^{c}]", "")) for c in ("A-Z", "a-z"))
    cases = F.array(upper, lower, F.length(token) - upper - lower)
    parts = let(
        encoding, lambda e: F.struct(places(e).alias("at"), e["classes"].alias("classes"), e["kinds"].alias("kinds"))
    )
    p = let(parts, lambda x: let(cases, lambda c: _combined(x["at"], x["classes"], c, x["kinds"])))
    return F.struct(
        p.alias("p"),
        F.size(F.array_distinct(chars)).alias("distinct"),
        F.size(F.filter(cases, lambda c: c > 0)).alias("cases"),
    )


def _chi(counts: Column, shares: Column, n: Column) -> Column:
    """p-value of chi-squared, as a normal score by Wilson and Hilferty; shares of 0 are left out."""
    terms = F.zip_with(
        counts, shares, lambda c, s: F.when(s > 0, (c - n * s) * (c - n * s) / (n * s)).otherwise(F.lit(0.0))
    )
    chi = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    df = (F.size(F.filter(shares, lambda s: s > 0)) - 1).cast("double")
    z = (F.pow(chi / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    return let(z, lambda z: F.when(z > 0, _normal_tail(z) / 2).otherwise(F.lit(0.5)))


def _combined(at: Column, classes: Column, cases: Column, kinds: Column) -> Column:
    """Smallest p-value of the five tests, times five."""
    n = F.size(at).cast("double")
    pairs = F.sequence(F.lit(1), F.greatest(F.size(at) - 1, F.lit(1)))
    counts = F.transform(
        F.sequence(F.lit(0), F.lit(CLASSES - 1)),
        lambda k: F.size(F.filter(at, lambda x: F.floor(x * CLASSES) == k)),
    )
    # Each of three cases may be absent: a small value comes up three times as often.
    present = F.aggregate(
        F.zip_with(cases, kinds, lambda c, s: F.when(c > 0, s).otherwise(F.lit(0.0))), F.lit(0.0), lambda a, x: a + x
    )
    p_chi = F.least(_chi(counts, classes, n), _chi(cases, kinds, n), 3 * F.pow(present, n))

    def runs(high: Column) -> Column:
        """Runs above and below the middle."""
        n1 = F.aggregate(high, F.lit(0), lambda a, x: a + x).cast("double")
        count = 1 + F.size(F.filter(pairs, lambda i: F.get(high, i) != F.get(high, i - 1)))
        mean = 2 * n1 * (n - n1) / n + 1
        spread = F.sqrt(F.greatest((mean - 1) * (mean - 2) / F.greatest(n - 1, F.lit(1.0)), F.lit(1e-9)))
        return F.when(n1 * (n - n1) == 0, F.lit(10.0)).otherwise((count - mean) / spread)

    z_runs = let(F.transform(at, lambda x: (x > 0.5).cast("int")), runs)

    # Neighbours of independent uniform numbers: a product has variance 1/144.
    products = F.aggregate(
        pairs,
        F.lit(0.0),
        lambda a, i: a + F.coalesce((F.get(at, i) - 0.5) * (F.get(at, i - 1) - 0.5), F.lit(0.0)),
    )
    z_serial = 12 * products / F.sqrt(F.greatest(n - 1, F.lit(1.0)))
    tails = let(F.array(z_runs, z_serial), lambda z: F.transform(z, _normal_tail))
    return F.least(F.lit(1.0), 5 * F.least(p_chi, F.array_min(tails)))


def length_class(n: Column) -> Column:
    out = F.lit(len(LENGTHS) - 1)
    for k in range(len(LENGTHS) - 2, -1, -1):
        out = F.when(n < LENGTHS[k + 1], F.lit(k)).otherwise(out)
    return out


def step_of(p: Column) -> Column:
    """Number of the step of a p-value, larger for smaller values."""
    return F.least(F.floor(-5 * F.log10(F.greatest(p, F.lit(1e-300)))), F.lit(STEPS)).cast("int")


def _candidates(text: Column) -> Column:
    """All long tokens with their places and test results."""
    token = lambda s: F.substring(text, (s["at"] + 1).cast("int"), (s["to"] - s["at"]).cast("int"))

    def judged(s: Column) -> Column:
        return let(
            battery(token(s)),
            lambda b: F.struct(
                s["at"].alias("at"), s["to"].alias("to"),
                b["p"].alias("p"), b["distinct"].alias("distinct"), b["cases"].alias("cases"),
            ),
        )

    return F.transform(matches(text, TOKEN), judged)


def thresholds(docs: DataFrame, text_col: str = "text", level: float = LEVEL) -> list[int]:
    """Per class of length, the step from which on tokens are declared not random.

    Benjamini and Hochberg on counts: the largest p whose expected number of random tokens
    at or below it is within ``level`` of the number found there. The counts have at most
    classes * (STEPS + 1) rows whatever the input.
    """
    tokens = docs.select(F.explode(_candidates(text_of(text_col))).alias("t"))
    counts = (
        tokens.groupBy(length_class(F.col("t.to") - F.col("t.at")).alias("class"), step_of(F.col("t.p")).alias("step"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    out = []
    for k in range(len(LENGTHS)):
        own = {r["step"]: r["n"] for r in counts if r["class"] == k}
        total, below, cut = sum(own.values()), 0, STEPS + 1
        for step in range(STEPS, -1, -1):
            below += own.get(step, 0)
            if below and total * 10 ** (-step / 5) <= level / len(LENGTHS) * below:
                cut = step
        out.append(cut)
    return out


def spans_of(docs: DataFrame, text_col: str = "text", level: float = LEVEL) -> Column:
    """array<struct<at, kind, to>> of a row of ``docs``, by start and order of kinds.

    What counts as random is settled over all of ``docs`` first.
    """
    cuts = F.array(*[F.lit(c) for c in thresholds(docs, text_col, level)])
    text = text_of(text_col)

    def marked(spans: Column, kind: int) -> Column:
        return F.transform(
            spans, lambda s: F.struct(s["at"].alias("at"), F.lit(kind).alias("order"), s["to"].alias("to"))
        )

    base = F.array_sort(
        F.concat(*[
            marked(F.filter(matches(text, pattern, group), lambda s: s["length"] >= least), k)  # noqa: B023
            for k, (_, pattern, group, least) in enumerate(BASE)
        ])
    )
    # By chance a token of n characters has about 16 * (1 - (15/16)**n) different ones of 16;
    # one with fewer than half of that is not taken for random.
    def enough(s: Column) -> Column:
        n = s["to"] - s["at"]
        return (s["distinct"] >= 8 * (1 - F.pow(F.lit(15 / 16), n))) & ((n >= SHORT) | (s["cases"] > 1))

    def all_spans(base: Column) -> Column:
        free = lambda s: ~F.exists(base, lambda b: (b["at"] < s["to"]) & (s["at"] < b["to"]))
        random = F.filter(
            _candidates(text),
            lambda s: (step_of(s["p"]) < F.get(cuts, length_class(s["to"] - s["at"]))) & enough(s) & free(s),
        )
        return F.array_sort(F.concat(base, marked(random, len(BASE))))

    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.transform(
        let(base, all_spans),
        lambda s: F.struct(s["at"].alias("at"), F.get(kinds, s["order"]).alias("kind"), s["to"].alias("to")),
    )


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", level: float = LEVEL) -> DataFrame:
    """id and spans (see ``spans_of``) of every row."""
    return docs.select(F.col(id_col).alias("id"), spans_of(docs, text_col, level).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["at"].cast("string"), s["to"].cast("string"))), ","
    )


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; overlaps become one.

    ``spans`` are sorted by start, as ``find`` returns them.
    """
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(s["at"] - acc["at"], F.lit(0)).cast("int"))
        mark = F.when(s["at"] >= acc["at"], F.concat(F.lit("<"), s["kind"], F.lit(">"))).otherwise("")
        return F.struct(F.greatest(acc["at"], s["to"]).alias("at"), F.concat(acc["out"], gap, mark).alias("out"))

    done = F.aggregate(spans, start, step)
    rest = F.substring(text, (done["at"] + 1).cast("int"), F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(done["out"], rest))
