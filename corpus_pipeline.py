"""The corpus pipeline: recognise the language, drop near copies, redact live secrets, mix sources, tokenise.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again before the next one. All
but the last return the columns of documents. Other columns of the input are dropped. A stage's result is defined for nulls
as its operator's is.
"""

from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placemetrics.llm import bpe, language_id, mixing, near_dedup, secret_scan
from placemetrics.llm.common import fold, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def recognise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with enough confidence."""
    model = language_id.fit(docs.filter(fold("doc_id", 3) != 1))
    return language_id.identify(docs.select(*COLUMNS), model, COLUMNS).filter("not rejected").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: of its smallest doc_id. Rows that repeat it become one row."""
    kept = near_dedup.classes(docs).filter("kept").select(F.col("doc_id").alias("kept_id"), F.col("content").alias("kept_content")).distinct()
    rows = docs.select(*COLUMNS).withColumn("content", near_dedup.content())
    named = rows.join(kept, rows["doc_id"].eqNullSafe(kept["kept_id"]) & (rows["content"] == kept["kept_content"]), "left_semi")
    one = named.groupBy("doc_id", "content").agg(F.min(F.struct("lang", "source", "n_chars", "text")).alias("row"))
    return one.select("doc_id", "row.text", "row.lang", "row.source", "row.n_chars")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with live-looking secrets replaced in their texts; widely copied examples stay."""
    live = secret_scan.scan(docs).filter(F.size("live") > 0).select("row", "content", "live").dropDuplicates(["row", "content"])
    rows = docs.select(*COLUMNS).withColumns({"row": F.xxhash64("doc_id", "source"), "content": F.xxhash64(F.coalesce("text", F.lit("")))})
    found = rows.join(live, ["row", "content"], "left").withColumn("clean", F.when(F.col("live").isNotNull(), secret_scan.redact(F.col("text"), F.col("live"))))
    length = F.when(F.col("clean").isNotNull(), F.length("clean").cast("long")).otherwise(F.col("n_chars"))
    return found.select("doc_id", F.coalesce("clean", "text").alias("text"), "lang", "source", length.alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix to target weights takes it, in whole copies, in the order of the slots in which they begin."""
    keys = ["doc_id", "source", "content", "size"]
    mixed = mixing.mix(docs).groupBy(*keys).agg(F.avg("taken").alias("taken"), F.min("starts").alias("starts"))
    taken = mixed.select(*(F.col(k).alias(f"mix_{k}") for k in keys), "taken", "starts").withColumn("copies", mixing.copies("mix_size", "taken", "mix_doc_id"))
    rows = docs.select(*COLUMNS).withColumn("content", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    same = rows["doc_id"].eqNullSafe(taken["mix_doc_id"]) & rows["source"].eqNullSafe(taken["mix_source"]) & (rows["content"] == taken["mix_content"])
    joined = rows.join(taken.filter("copies > 0"), same)
    begun = joined.withColumn("slot", F.explode(F.slice("starts", F.lit(1), F.col("copies"))))
    return begun.repartitionByRange("slot").sortWithinPartitions("slot", "doc_id").select(*COLUMNS)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document (packed little-endian unsigned 32-bit integers) and the text that they decode to."""
    ranks = bpe.rank_file(tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe.transcode(docs, ["doc_id", "source"], ranks, tokenizers.PATTERN, decode=True)
    return coded.select("doc_id", "source", "n_tokens", "ids", F.col("decoded").cast("string").alias("text"))


STAGES = [
    ("language_id", recognise),
    ("near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
    ("bpe", tokenise),
]

#: Language and near-copy classes are beyond SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
