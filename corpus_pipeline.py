"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the stage before kept and returns documents again, with the same
columns; the last returns the pieces of all documents with their places in sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from stakescore import staging
from stakescore.llm import language, line_dedup, packing, simhash, toxicity
from stakescore.llm.workers import prepare

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID, CAPACITY = 1, 4096


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose text is not found toxic."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxicity(docs, labels, carry=True).filter("predicted = 0").select("doc.*")


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in a language that the corpus teaches, beyond doubt."""
    prepare(spark)
    return language.language_id(docs, carry=True).filter(~F.col("rejected")).select("doc.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the lines that recur throughout their source; copies of a text count once."""
    prepare(spark)
    cut = line_dedup.drop_boilerplate(docs, "source", copies=False)
    return cut.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document of the smallest doc_id; those without one stay."""
    prepare(spark)
    groups = staging.written(simhash.near_duplicates(docs, width=4, radius=4, versions=True), "groups")
    first = groups.filter("doc_id = component_id")
    # Ids that repeat within their component: the text of the least version stays, once.
    repeated = staging.written(
        first.groupBy("component", "doc_id").agg(F.min("version").alias("kept"), F.count("*").alias("n")).filter("n > 1"), "repeated")
    key = [F.col("doc_id").alias("key_id"), F.col("version").alias("key_version")]
    dropped = staging.written(
        groups.filter("doc_id <> component_id").unionByName(
            first.join(repeated.select("component", "doc_id"), ["component", "doc_id"], "left_semi").select(*groups.columns)
        ).select(*key).distinct(), "dropped")
    once = repeated.select(F.col("doc_id").alias("key_id"), F.col("kept").alias("key_version"))
    same = (F.col("doc_id") == F.col("key_id")) & (F.xxhash64("text") == F.col("key_version"))
    rest = docs.join(dropped.hint("shuffle_hash"), same, "left_anti")
    one = docs.join(once, same, "left_semi").withColumn("version", F.xxhash64("text")).dropDuplicates(["doc_id", "version"])
    return rest.unionByName(one.drop("version"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of all documents in sequences of at most ``CAPACITY`` tokens."""
    prepare(spark)
    return packing.best_fit(packing.pieces(docs, TOKENIZER, END_ID, CAPACITY), CAPACITY)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack),
]

#: Toxicity, languages, near duplicates and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staging.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
