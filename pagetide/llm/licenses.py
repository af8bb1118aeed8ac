"""License scans: exact phrases, and license texts found by diagonal voting.

Every text's words are hashed in rolling groups of ``k``. All these hashes are joined to the
positions of the same groups in the license templates. A hit votes for a diagonal, its
position in the text minus its position in the template: an unchanged copy puts all its hits
on one diagonal, an inserted or dropped word moves the rest to the next. Hits are counted per
diagonal, run by run; runs on neighbouring diagonals are merged, and so are, after longer
insertions and cuts, runs that go on in the template's order close together in the text. Runs that
lie in the place of a longer one, as repeated phrases cause, are left out. Spans that hold enough
of the template count. Every hit is verified by comparing its words with the template's.

The templates are a parameter with a size bound (``MAX_GRAMS`` positions in all), so the
table that is broadcast cannot grow with the input. Only hits are shuffled, after equal ones
have been merged within each task. Texts are told apart by a digest, so copies of a text are
scanned where they are read and judged once.

Defined cases: a null text is empty and has no words; repeated rows get equal results; a text
without any hit has an empty list of spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pagetide.llm.common import join_counted, lower_ascii, text_of
from pagetide.llm.license_texts import TEXTS
from pagetide.sources.tables import stored

#: Phrase and label.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
#: Openings of well-known license texts, lower case, punctuation left out.
TEMPLATES = {
    "apache": "licensed under the apache license version 2 0 the license you may not use this file except in "
    "compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 "
    "unless required by applicable law or agreed to in writing software distributed under the license is "
    "distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided "
    "that the following conditions are met redistributions of source code must retain the above copyright notice "
    "this list of conditions and the following disclaimer redistributions in binary form must reproduce the above "
    "copyright notice this list of conditions and the following disclaimer in the documentation and or other "
    "materials provided with the distribution",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
    "general public license as published by the free software foundation either version 3 of the license or at "
    "your option any later version this program is distributed in the hope that it will be useful but without any "
    "warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-short": "this work is licensed under the gnu general public license version 3",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
    "hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the software to deal in the software without restriction including without "
    "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the "
    "software and to permit persons to whom the software is furnished to do so subject to the following conditions "
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the software",
    "mit-short": "released under the mit license",
    "apache-short": "licensed under the apache license version 2 0",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl "
    "was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
}
K = 4
MAX_GRAMS = 100_000
#: Words of a passage of a whole text, at least; each passage is a template.
PASSAGE = 80
#: The clauses that follow the openings, and notices of further licenses.
CLAUSES = {
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not "
    "limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event "
    "shall the authors or copyright holders be liable for any claim damages or other liability whether in an action "
    "of contract tort or otherwise arising from out of or in connection with the software or the use or other "
    "dealings in the software",
    "bsd-endorsement": "neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written permission",
    "bsd-warranty": "this software is provided by the copyright holders and contributors as is and any express or "
    "implied warranties including but not limited to the implied warranties of merchantability and fitness for a "
    "particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any "
    "direct indirect incidental special exemplary or consequential damages including but not limited to procurement "
    "of substitute goods or services loss of use data or profits or business interruption however caused and on any "
    "theory of liability whether in contract strict liability or tort including negligence or otherwise arising in "
    "any way out of the use of this software even if advised of the possibility of such damage",
    "isc-warranty": "the software is provided as is and the author disclaims all warranties with regard to this "
    "software including all implied warranties of merchantability and fitness in no event shall the author be liable "
    "for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use "
    "data or profits whether in an action of contract negligence or other tortious action arising out of or in "
    "connection with the use or performance of this software",
    "lgpl-notice": "the terms of the gnu lesser general public license as",
    "agpl-notice": "the terms of the gnu affero general public license as",
    "unlicense": "this is free and unencumbered software released into the public domain anyone is free to copy modify "
    "publish use compile sell or distribute this software either in source code form or as a compiled binary for any "
    "purpose commercial or non commercial and by any means",
    "zlib": "permission is granted to anyone to use this software for any purpose including commercial applications and "
    "to alter it and redistribute it freely subject to the following restrictions the origin of this software must not "
    "be misrepresented you must not claim that you wrote the original software",
    "boost": "distributed under the boost software license version 1 0",
    "epl": "made available under the terms of the eclipse public license",
}
#: Creative Commons notices: every kind and version, by its short and by its long name.
CC_KINDS = {
    "by": "attribution", "by sa": "attribution sharealike", "by nd": "attribution noderivatives",
    "by nc": "attribution noncommercial", "by nc sa": "attribution noncommercial sharealike",
    "by nc nd": "attribution noncommercial noderivatives",
}


def _cc_notices() -> dict[str, str]:
    out = {}
    for kind, long in CC_KINDS.items():
        for version in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            forms = [
                f"licensed under cc {kind} {version}", f"under a cc {kind} {version}", f"under the cc {kind} {version}",
                f"license cc {kind} {version}", f"creativecommons org licenses {kind} {version}",
                f"creative commons {long} {version}",
            ]
            out |= {f"cc-{kind} {version} {n}": form for n, form in enumerate(forms)}
    return out | {
        "cc-notice": "licensed under a creative commons", "cc-notice the": "licensed under the creative commons",
        "cc-zero": "creativecommons org publicdomain zero 1 0", "cc-zero 1": "licensed under cc0 1 0",
    }


def with_passages(templates: dict[str, str], texts: dict[str, str], k: int = K, words: int = PASSAGE) -> dict[str, str]:
    """``templates`` and the passages of ``texts``, which are cut into equal parts.

    A passage most of whose groups of words belong to a template of another license already,
    as GNU licenses share clauses, is left to that one.
    """
    grams = lambda text: {tuple(w[i : i + k]) for w in [text.split()] for i in range(len(w) - k + 1)}
    out, owners = dict(templates), {}
    for name, text in templates.items():
        for g in grams(text):
            owners.setdefault(g, name.split("-")[0])
    for name, text in texts.items():
        all_words, label = text.split(), name.split("-")[0]
        parts = max(1, len(all_words) // words)
        for n in range(parts):
            passage = " ".join(all_words[n * len(all_words) // parts : (n + 1) * len(all_words) // parts])
            own = grams(passage)
            if 2 * sum(owners.get(g, label) != label for g in own) <= len(own):
                out[f"{name} {n}"] = passage
        for g in grams(text):
            owners.setdefault(g, label)
    return out


TEMPLATES = with_passages(TEMPLATES | CLAUSES | _cc_notices(), TEXTS)
#: Diagonals up to so far apart belong to one span.
DRIFT = 3
#: Words that may stand between two runs of one span whose diagonals are further apart.
GAP = 50
#: Hits of one diagonal that are so many words apart belong to two runs.
BREAK = 2 * K
#: A span counts if it holds this share of its template's groups of words.
SHARE = 0.6
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a lower-cased text."""
    return F.filter(F.split(text, BREAKS), lambda w: w != "")


def rolling(words: Column, k: int) -> Column:
    """Hashes of all groups of k neighbouring words, empty for shorter texts.

    Groups of hashes of words: each word is hashed once.
    """
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    spots = F.sequence(F.lit(0), F.size(words) - k)
    grams = F.get(F.transform(F.array(hashes), lambda h: F.transform(spots, lambda i: _hash_at(h, i, k))), F.lit(0))
    return F.when(F.size(words) >= k, grams).otherwise(F.array().cast("array<bigint>"))


def _hash_at(hashes: Column, i: Column, k: int) -> Column:
    return F.xxhash64(*[F.get(hashes, i + j) for j in range(k)])


def template_grams(spark: SparkSession, templates: dict[str, str], k: int) -> DataFrame:
    """gram, template, spot, of, same: every group of every template, with its words."""
    rows = [(name, text.split()) for name, text in templates.items()]
    if sum(len(words) for _, words in rows) > MAX_GRAMS:
        raise ValueError(f"templates of more than {MAX_GRAMS} words")
    table = spark.createDataFrame(rows, "template string, words array<string>")
    return table.select(
        "template", "words", (F.size("words") - k + 1).alias("of"),
        F.posexplode(rolling(F.col("words"), k)).alias("spot", "gram"),
    ).select("gram", "template", "spot", "of", F.slice("words", F.col("spot") + 1, F.lit(k)).alias("same"))


def spans(
    docs: DataFrame,
    text_col: str = "text",
    templates: dict[str, str] | None = None,
    k: int = K,
    drift: int = DRIFT,
    share: float = SHARE,
    gap: int = GAP,
) -> DataFrame:
    """key, template, first, last, score of the verified spans of every distinct text.

    ``key`` is the digest of the text (see ``key_of``), ``first`` and ``last`` the span's
    words, ``score`` the share of the template's groups found in it. A hit is verified where
    it is found, while its text is at hand: its words must be the template's, so an agreement
    of hashes alone does not count. Only verified hits, numbers by then, are shuffled.
    """
    templates = TEMPLATES if templates is None else templates
    grams = template_grams(docs.sparkSession, templates, k)
    text = text_of(text_col)
    read = docs.select(key_of(text).alias("key"), words_of(lower_ascii(text)).alias("words"))
    # The groups are a column of their own, so that exploding and joining them is one piece of
    # generated code, in which a text's words are referred to and not copied. (The outer form
    # adds no filter that would build the groups twice.) There the words are compared, as
    # pairs of bounds: an equation would become one more join key, built for
    # every group and not for the hits alone.
    alike = F.lit(True)
    for j in range(k):
        mine, theirs = F.get("words", F.col("pos") + j), F.get("same", F.lit(j))
        alike = alike & (mine <= theirs) & (mine >= theirs)
    hits = (
        read.select("key", "words", rolling(F.col("words"), k).alias("grams"))
        .select("key", "words", F.posexplode_outer("grams").alias("pos", "gram"))
        .join(F.broadcast(grams), "gram")
        .filter(alike)
        .select("key", "template", "of", "pos", "spot", (F.col("pos") - F.col("spot")).alias("diagonal"))
        .distinct()
    )
    one = Window.partitionBy("key", "template", "of", "diagonal").orderBy("pos")
    broken = F.when(F.col("pos") - F.lag("pos").over(one) <= BREAK, 0).otherwise(1)
    runs = (
        hits.withColumn("broken", broken)
        .withColumn("run", F.sum("broken").over(one.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("key", "template", "of", "diagonal", "run")
        .agg(
            F.min("pos").alias("first"), F.max("pos").alias("last"), F.min("spot").alias("low"),
            F.max("spot").alias("high"), F.collect_list("spot").alias("spots"),
        )
    )
    order = ["first", F.desc("last"), "diagonal"]
    own = Window.partitionBy("key", "template").orderBy(*order)
    covered = F.coalesce(F.col("last") <= F.max("last").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))
    # Runs of a span follow each other in text and template. A single hit must be on a diagonal
    # next to its neighbours', or it is by itself, like a run in the place of a longer one.
    rest = Window.partitionBy("key", "template", "covered").orderBy(*order)
    next_to = lambda other: F.coalesce(F.abs(F.col("diagonal") - other) <= drift, F.lit(False))
    single = (F.size("spots") == 1) & ~next_to(F.lag("diagonal").over(rest)) & ~next_to(F.lead("diagonal").over(rest))
    chain = Window.partitionBy("key", "template", "alone").orderBy(*order)
    before = {c: F.lag(c).over(chain) for c in ("last", "high", "diagonal")}
    follows = (F.col("first") > before["last"] - k) & (F.col("low") > before["high"] - k)
    close = (F.col("first") - before["last"] <= gap + k) | next_to(before["diagonal"])
    merged = (
        runs.withColumn("covered", covered)
        .withColumn("alone", F.col("covered") | single)
        .withColumn("opened", F.when(~F.col("alone") & follows & close, 0).otherwise(1))
        .withColumn("span", F.sum("opened").over(chain.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("key", "template", "of", "alone", "span")
        .agg(
            F.min("first").alias("first"), (F.max("last") + k - 1).alias("last"),
            F.size(F.array_distinct(F.flatten(F.collect_list("spots")))).alias("found"),
        )
        .withColumn("score", F.col("found") / F.col("of"))
    )
    return merged.filter(F.col("score") >= share).select("key", "template", "first", "last", "score")


def key_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def phrase_places(words: Column, phrase: str) -> Column:
    """Starts of the places where the phrase's words stand one after the other."""
    parts = phrase.split()
    last = F.size(words) - len(parts)
    spots = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(
        F.array().cast("array<int>")
    )
    def here(i: Column) -> Column:
        out = F.get(words, i) == parts[0]
        for j, part in enumerate(parts[1:], 1):
            out = out & (F.get(words, i + j) == part)
        return out

    # Most texts lack a word of the phrase and are not searched.
    return F.when(F.array_contains(words, parts[-1]), F.filter(spots, here)).otherwise(
        F.array().cast("array<int>")
    )


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: list[tuple[str, str]] | None = None,
    templates: dict[str, str] | None = None,
) -> DataFrame:
    """id, n_words, places: array<struct<at, label>>, spans: array<struct<template, first, last, score>>."""
    phrases = PHRASES if phrases is None else phrases
    text = text_of(text_col)
    per_text = spans(docs, text_col, templates).groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("template", "first", "last", "score"))).alias("spans")
    )
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"), key_of(text).alias("key"),
            _base(words_of(lower_ascii(text)), phrases).alias("base"),
        )
    )
    # Only texts with spans are joined; how often each occurs is counted on their digests.
    counted = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    spread = F.coalesce(F.col("id").cast("string"), F.lit(""))
    joined = join_counted(rows, stored(per_text.join(counted, "key")), ["key"], "n", rows.count(), spread, "left")
    none = F.array().cast("array<struct<template:string,first:int,last:int,score:double>>")
    return joined.select("id", "base.n_words", "base.places", F.coalesce("spans", none).alias("spans"))


def _base(words: Column, phrases: list[tuple[str, str]]) -> Column:
    def of(w: Column) -> Column:
        places = [
            F.transform(phrase_places(w, p), lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))  # noqa: B023
            for p, label in phrases
        ]
        return F.struct(F.size(w).cast("bigint").alias("n_words"), F.array_sort(F.concat(*places)).alias("places"))

    return F.get(F.transform(F.array(words), of), F.lit(0))


def label_of(template: Column) -> Column:
    """A template's license: its name up to the first hyphen."""
    return F.substring_index(template, "-", 1)
