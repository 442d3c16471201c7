"""A training corpus out of the table documents, in five stages.

Every stage takes what its predecessor kept and its decisions take effect: texts in no language
go, one document of each group of near duplicates stays, repeated passages and personal data are
taken out of the texts, and what is left is packed into batches. Between stages the documents are
written to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import length_buckets, odd_sketch, ppm_language, skip_chain, suffix_levels
from tallyline.workspace import stored

#: Bits a text may take beyond its language's limit, so that a few odd words alone reject nothing.
SLACK_BITS = 128
ROW = "pipeline_row"


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep texts in one of the learned languages and fill in a missing ``lang``.

    A text goes if it has no letter, or if its code is much longer than that of texts in its
    language that were not learned from. A language without such texts has no limit.
    """
    learned = docs.filter(~ppm_language.held_out()).select("text", "lang")
    trees = ppm_language.trained(learned)
    found = ppm_language.detected(docs, trees)
    size = F.octet_length("text")
    # One number for each learned language; in an expression they need no join.
    unseen = ppm_language.detected(docs.filter(ppm_language.held_out()), trees)
    limits = [F.lit(x) for row in ppm_language.rate_limits(unseen).collect() for x in row]
    limit = F.create_map(*limits)[F.col("lang_pred")] if limits else F.lit(None).cast("double")
    foreign = F.col("bits_per_byte") * size > limit * size + SLACK_BITS
    kept = found.filter((F.col("lang_pred") != ppm_language.UNDETERMINED) & ~F.coalesce(foreign, F.lit(False)))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the smallest doc_id of each group (five words, similarity 0.8).

    Rows are told apart by 64 bits over all their columns, so that different texts of one doc_id and rows
    without doc_id are each judged by their text; of rows equal in every column one stays. Texts
    without words are in no group; of such rows with one doc_id and one text, one stays.
    """
    values = [F.sha2("text", 256) if c == "text" else F.col(c) for c in docs.columns]
    keyed = docs.withColumn(ROW, F.xxhash64(*[x for v in values for x in (v.isNull(), v)]))
    groups = odd_sketch.near_duplicates(keyed.select(F.col(ROW).alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias(ROW), F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("group"))
    names = keyed.groupBy(ROW).agg(
        F.count("*").alias("copies"), F.first("doc_id").alias("doc_id"), F.first(F.sha2("text", 256)).alias("digest")
    )
    named = stored(names.join(groups.distinct(), ROW), "named")
    lone = F.when(F.col("group").isNull(), F.struct("doc_id", "digest"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW)).alias("first")
    stay = named.groupBy("group", lone.alias("lone")).agg(first).select(F.col("first")[ROW].alias(ROW))
    # Stored, so that their size is known when the texts are joined to them.
    gone = stored(named.select(ROW).join(stay, ROW, "left_anti"), "gone")
    repeated = stored(named.filter("copies > 1").select(ROW), "repeated")
    kept = keyed.join(gone, ROW, "left_anti")
    equal = kept.join(repeated, ROW, "left_semi").dropDuplicates([ROW])
    return kept.join(repeated, ROW, "left_anti").unionByName(equal).select(docs.columns)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove the bytes of passages that also start earlier in the corpus."""
    return _sized(suffix_levels.without_repeats(docs))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask personal data."""
    return _sized(skip_chain.masked(docs, skip_chain.fitted(docs)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the texts into batches of like length."""
    return length_buckets.packed(docs)


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("pii", pii),
    ("packing", packing),
]

#: No SQL for trained models and loopy inference; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
