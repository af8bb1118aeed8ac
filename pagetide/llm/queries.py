"""Registered queries of the corpus operators, each over a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pagetide.llm import bpe, counts, exact, langid, licenses, negatives, packing, phrases, quality, rotations, secrets, simhash, urls

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
    Q[fn.__name__] = fn
    return fn


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file, which every machine has installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@register
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.train(docs.filter(~langid.held_out("doc_id")))
    found = langid.identify(docs, model)
    return found.select(
        F.col("id").alias("doc_id"), langid.held_out("id").alias("held_out"), "lang_pred", "score"
    )


@register
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = packing.pieces(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))
    parts = parts.select("id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(parts).withColumnRenamed("id", "doc_id")


@register
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.verdicts(exact.dedup(documents(spark, sf_dir)))
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("text_key").alias("text_sha256")
    )


SQL["op6_exact_dedup"] = """
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = max(doc_id) over w as kept, sha256(coalesce(text, '')) as text_sha256
from documents window w as (partition by coalesce(text, ''))
"""


@register
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(documents(spark, sf_dir))
    fixed = F.filter("spans", lambda s: s["kind"] != "random")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        F.col("id").alias("doc_id"),
        *[count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secrets.written(fixed), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
    )


@register
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


@register
def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("word_bpe_49k.json")
    found = bpe.encode(documents(spark, sf_dir), path, decode=True)
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(documents(spark, sf_dir))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    base = F.transform("places", lambda p: p["label"])
    spans = F.transform("spans", lambda s: licenses.label_of(s["template"]))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.get("places", F.lit(0))["at"].cast("bigint").alias("first_word"),
        F.get("places", F.size("places") - 1)["at"].cast("bigint").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, spans)).alias("labels"),
        F.coalesce(
            F.when(F.size("places") > 0, F.lit(1.0)), F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)
        ).alias("score"),
    )


@register
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = counts.count_tokens(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit")
    )


@register
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.assess(documents(spark, sf_dir), measures=True, first=quality.BASE)
    return found.select(
        F.col("id").alias("doc_id"), *quality.MEASURES, F.col("first_failed").alias("base_failed"), "kept"
    )


#: Names in hosts whose pages make up the list of the query.
UNWANTED = "(^|[.-])(adult|ads|bets|casino|spam)([.-]|$)"


@register
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    listed = pages.filter(urls.host_of(F.col("url")).rlike(UNWANTED))
    return urls.judge(pages, listed).select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


SQL["op10_url_filter"] = rf"""
with a as (
  select page_id, url, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages
), b as (
  select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw_host,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path,
         list_sort([q for q in string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&')
                    if q <> '' and not regexp_matches(q, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)')]) as params
  from a
), c as (
  select page_id, host, path,
         case when host <> '' then regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/+$', '')
              || case when len(params) > 0 then '?' || array_to_string(params, '&') else '' end end as canonical
  from b
), r(verdict, of, start) as (
  values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fit as (
  select page_id, arg_max(of || start, length(of || start)) as rule, arg_max(verdict, length(of || start)) as verdict
  from c join r on (host = of or ends_with(host, '.' || of)) and starts_with(path, start)
  group by page_id
), listed as (
  select distinct canonical from c where regexp_matches(host, '{UNWANTED}')
)
select c.page_id, host, path, rule,
       coalesce(fit.verdict, case when canonical in (select canonical from listed) then 'block' else 'allow' end) as verdict
from c left join fit on c.page_id = fit.page_id
"""


@register
def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


SQL["op11_phrase_mining"] = r"""
with pieces as (
  select row_number() over () as piece, lang, words from (
    select lang, list_filter(regexp_split_to_array(part, '[ \t]+'), lambda w: w <> '') as words from (
      select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) as part
      from documents))
), grams as (
  select lang, k as length, unnest([array_to_string(words[i:i + k - 1], ' ') for i in range(1, len(words) - k + 2)]) as phrase
  from pieces, (select unnest([1, 2, 3, 4]) as k) where len(words) >= k
), counts as (
  select lang, length, phrase, count(*) as f, string_split(phrase, ' ') as words from grams group by all
), sizes as (
  select lang, sum(f) as n from counts where length = 1 group by lang
), frequent as (
  select * from counts where length > 1 and f >= 30
), inner_parts as (
  select lang, array_to_string(words[i:i + k - 1], ' ') as phrase, f
  from (select lang, words, f, length, k, unnest(range(1, length - k + 2)) as i
        from frequent, (select unnest([2, 3]) as k) where k < length)
), candidates as (
  select * from frequent c where not exists (
    select 1 from inner_parts p where p.lang = c.lang and p.phrase = c.phrase and 100 * p.f::hugeint >= 80 * c.f::hugeint)
), cuts as (
  select lang, phrase, f as a, k, array_to_string(words[1:k], ' ') as head, array_to_string(words[k + 1:length], ' ') as tail
  from (select *, unnest(range(1, length)) as k from candidates)
), scored as (
  select c.lang, c.phrase, c.a, c.k, h.f as l, t.f as r, (2000000 * c.a::hugeint) // (h.f::hugeint + t.f::hugeint) as score
  from cuts c join counts h on h.lang = c.lang and h.phrase = c.head join counts t on t.lang = c.lang and t.phrase = c.tail
), best as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best
)
select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked join sizes using (lang) where rank <= 2000
"""


@register
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = negatives.mine(rows.withColumn("label", moved), anchor=F.col("vec_id") % 50 == 0)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


SQL["op12_hard_negatives"] = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), pairs as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
         list_inner_product(a.v, b.v)::bigint as score
  from rows a join rows b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0
), positives as (
  select * from pairs where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
)
select p.anchor_id, p.other_id as positive_id,
       row_number() over (partition by p.anchor_id, p.other_id order by q.score desc, q.other_id)::int as rank,
       q.other_id as negative_id, p.score as positive_score, q.score as negative_score
from positives p join pairs q on p.anchor_id = q.anchor_id and not q.same
  and 50 * p.score <= 100 * q.score and 100 * q.score <= 95 * p.score
qualify rank <= 3
"""


@register
def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = rotations.near_vectors(rows, "vec_id", "embedding")
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")
