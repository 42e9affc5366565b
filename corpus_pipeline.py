"""From raw documents to a training mix, in stages that each write a table.

Every stage takes the documents that the one before kept, decides on all of them,
and hands on the rows it keeps with all their columns. The last one adds how often
the mix repeats a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexmill.llm import decontam, langid, minhash, mixing, toxicity
from vertexmill.llm.tables import fresh, join_by, scratch_path, table, written
from vertexmill.runtime import drop_written

#: Percentage of shared five-word shingles from which documents are near duplicates.
SIMILARITY = 80


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below 0.5; null and empty texts stay."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters of which the learned languages fill at least half."""
    return langid.with_language(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, the one with the least doc_id.

    Rows equal in doc_id and text are one document and leave one row; all others
    are documents of their own, also where they share a doc_id or have none. One
    without a doc_id stays only where its component has no other.
    """
    key = fresh("_key", docs.columns)
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    nodes = minhash.near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"), percent=SIMILARITY)
    found = written(nodes.select(F.col("doc_id").alias(key), "component_id").distinct(), "near-found")
    ids = written(keyed.groupBy(key).agg(F.min("doc_id").alias("id"), F.count("*").alias("rows")), "near-ids")
    members = written(found.join(ids, key), "near-members")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", key))
    stays = members.groupBy("component_id").agg(first[key].alias("stays"), F.count("*").alias("n")).filter("n > 1")
    groups = written(stays.drop("n"), "near-groups")
    others = join_by(members, groups, ["component_id"], "inner", spread=key).filter(F.col(key) != F.col("stays"))
    gone = written(others.select(key), "near-gone")
    again = written(ids.filter("rows > 1").select(key), "near-again")
    kept = join_by(keyed, gone, [key], "left_anti")
    once = join_by(kept, again, [key], "left_anti")
    drop_written(found, ids, members, groups)
    return once.unionAll(join_by(kept, again, [key], "left_semi").dropDuplicates([key])).drop(key)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes, with ``copies`` and ``taken`` words."""
    return mixing.mixed_rows(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("language", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
]

#: SQL can't express the stages; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
