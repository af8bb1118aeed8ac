"""A training corpus from raw documents: five stages over whole tables.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns
documents with the columns it was given; the last one returns their packing. ``run`` writes
each stage's result to the shared folder and reads it again for the next.

Rows keep all their columns, whatever they are called. Of repeated rows, and of copies that
all lack an id, one row stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pagetide.llm import exact, langid, packing, secrets, shingles
from pagetide.llm.common import free_name, keep_one, text_of
from pagetide.llm.queries import documents, tokenizer
from pagetide.sources.tables import stored, use_local_dir

#: A document whose language is less certain than this is rejected, and so is one without any.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the operator tells; learned from the labelled fold."""
    use_local_dir(spark)
    model = langid.train(docs.filter(~langid.held_out("doc_id")))
    name = free_name(docs.columns, "found")
    found = docs.withColumn(name, langid.predict(spark, model, text_of()))
    sure = (F.col(f"{name}.lang") != langid.UNKNOWN) & (F.col(f"{name}.score") >= LEAST_SCORE)
    return found.filter(sure).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: one with the largest id."""
    use_local_dir(spark)
    kept = exact.verdicts(exact.dedup(docs)).filter("kept").groupBy(F.col("id").alias("_id"), F.col("text_key").alias("_key"))
    return keep_one(docs, kept.agg(F.count(F.lit(1)).alias("_n")), "doc_id", F.sha2(text_of(), 256))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts linked by their shingles: one with the smallest id."""
    use_local_dir(spark)
    kept = shingles.kept_of(shingles.near_copies(docs))
    return keep_one(docs, kept, "doc_id", F.sha2(text_of(), 256))


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in the text replaced by its kind; n_chars follows."""
    use_local_dir(spark)
    name = free_name(docs.columns, "spans")
    found = docs.withColumn(name, secrets.spans_of(docs)).withColumn(
        "text", secrets.redact(F.col("text"), F.col(name))
    )
    if "n_chars" in docs.columns:
        changed = (F.size(name) > 0) & F.col("n_chars").isNotNull()
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn(
            "n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        )
    return found.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    use_local_dir(spark)
    parts = packing.pieces(docs, tokenizer("byte_bpe_50k.json"))
    parts = parts.select("id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(parts).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("secrets", remove_secrets),
    ("packing", pack),
]

#: Fingerprints, components and packing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_local_dir(spark)
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
