"""URL filters: rules by host and path, and a list of URLs behind a blocked Bloom filter.

Only DataFrame functions are used. Rules name a host, with all its subdomains, and the start
of a path; the longest that fits decides. A URL without a rule is looked up in the list, by
its canonical form. The list may be large, so most URLs are told apart from it by a Bloom
filter: a URL's hash picks a block of eight 64-bit words and one bit in each of them. The
filter is a table with one row per block, at most ``MAX_BLOCKS`` of them (about 10 MB), which
bounds the broadcast; a longer list makes it less selective, never wrong. Possible hits go to
an exact join with the list, in which a URL with many rows is cut into parts.

Defined cases: null URLs and those without ``://`` have empty host and path, fit no rule, and
are allowed; repeated rows get equal verdicts; an empty list allows what no rule blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pagetide.llm.common import join_counted, lower_ascii
from pagetide.sources.tables import stored

#: Verdict, host, start of the path.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
WORDS = 8
BITS_PER_URL = 16
MAX_BLOCKS = 1 << 17
#: Parts of a query string that do not change the page.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without www. or m., path without a closing slash, query without tracking, sorted."""
    rest = _after_scheme(url)
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda q: (q != "") & ~q.rlike(TRACKING)))
    asked = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host != "", F.concat(host, path, asked))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    # The last written is tested first: longest first, then by name.
    for verdict, of, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]])):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(of + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def block_count(listed: int) -> int:
    """A power of two of 512-bit blocks that gives each URL BITS_PER_URL bits, within the bound."""
    wanted = max(1, listed * BITS_PER_URL // (64 * WORDS))
    return min(MAX_BLOCKS, 1 << (wanted - 1).bit_length())


def _place(key: Column, blocks: int) -> tuple[Column, Column]:
    """Block of a key, and its bit in each word of the block."""
    block = F.pmod(F.xxhash64(key), F.lit(blocks).cast("bigint"))
    second = F.xxhash64(key, F.lit(1))
    bits = F.array(
        *[F.shiftrightunsigned(second, 6 * j).bitwiseAND(F.lit(63).cast("bigint")).cast("int") for j in range(WORDS)]
    )
    return block, bits


def _mask(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """block and its words w0 to w7, from ``listed(canonical)``."""
    block, bits = _place(F.col("canonical"), blocks)
    placed = listed.select(block.alias("block"), bits.alias("bits"))
    return placed.groupBy("block").agg(*[F.bit_or(_mask(F.get("bits", F.lit(j)))).alias(f"w{j}") for j in range(WORDS)])


def judge(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    listed_col: str = "url",
) -> DataFrame:
    """id, host, path, rule, verdict, listed of every page; ``listed`` is a table of URLs."""
    known = stored(
        listed.select(canonical(F.col(listed_col)).alias("canonical")).filter("canonical is not null").distinct()
    )
    blocks = block_count(known.count())
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canonical"))
    rows = rows.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    block, bits = _place(F.col("canonical"), blocks)
    words = F.array(*[F.col(f"w{j}") for j in range(WORDS)])
    hit = F.forall(F.zip_with(words, "bits", lambda w, b: w.bitwiseAND(_mask(b)) != 0), lambda x: x)
    tested = (
        rows.withColumn("block", block)
        .withColumn("bits", bits)
        .join(F.broadcast(bloom(known, blocks)), "block", "left")
        .select("id", "host", "path", "canonical", "fit", F.coalesce(F.col("w0").isNotNull() & hit, F.lit(False)).alias("maybe"))
    )
    tested = stored(tested)
    free = tested.filter("not maybe").withColumn("listed", F.lit(False))
    maybe = tested.filter("maybe")
    counted = maybe.groupBy("canonical").agg(F.count(F.lit(1)).alias("n")).join(known, "canonical")
    counted = stored(counted.withColumn("listed", F.lit(True)))
    spread = F.coalesce(F.col("id").cast("string"), F.lit(""))
    found = join_counted(maybe, counted, ["canonical"], "n", tested.count(), spread, "left")
    cols = ["id", "host", "path", "fit", "listed"]
    every = free.select(*cols).unionByName(found.withColumn("listed", F.coalesce("listed", F.lit(False))).select(*cols))
    verdict = F.coalesce("fit.verdict", F.when(F.col("listed"), F.lit("block")).otherwise("allow"))
    return every.select("id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), "listed")
