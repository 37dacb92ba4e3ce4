"""From raw documents to training shards: language, near-duplicates, benchmark leaks, source mix, shards.

Every stage is a function (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the last
return the columns of documents, in their order, whatever other columns there are. An empty table goes through all of
them; nulls, empty texts and repeated rows are handled as each stage says."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import decontaminate, languages, mixing, neardup, sharding
from lodestone.llm.scratch import saved

#: The stages hash and compare texts, which SQL has no functions for; tests hold them against plain Python.
ORACLE_SQL = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach. Those without a letter go: null, empty and blank texts,
    digits and signs; all go if no row has a label. Repeated rows stay each."""
    return languages.identify(docs).filter("lang_pred <> 'und'").select("row.*")


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one with the least doc_id, null last; of repeated rows the first.
    A text without words is a class of its own and stays."""
    return neardup.keep_one(docs)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item. A document is found again by its id, which may be null or repeated, and a hash
    of its text; null and empty texts hold nothing and stay."""
    key = F.struct("doc_id", F.xxhash64("text").alias("text_hash")).alias("doc_id")
    found = decontaminate.contaminated(docs.select(key, "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaks = saved(found.select("doc_id.*").distinct(), "leaks")
    rows = docs.select(F.struct("*").alias("row"))
    same = F.col("row")["doc_id"].eqNullSafe(leaks["doc_id"]) & (F.xxhash64(F.col("row")["text"]) == leaks["text_hash"])
    return rows.join(leaks, same, "left_anti").select("row.*")


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; those without words are never taken."""
    return mixing.take(docs)


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in compacted shards, with the shard of each. A column of documents that is named like one of the
    shard's gets an underscore after it."""
    return sharding.located(sharding.shard(docs), docs.columns)


STAGES = [
    ("language", language_stage),
    ("near_duplicates", neardup_stage),
    ("decontaminate", leak_stage),
    ("mix", mix_stage),
    ("shard", shard_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on sf_dir's documents, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
