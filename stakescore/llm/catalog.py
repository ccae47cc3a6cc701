"""The queries of the operators, one for each, and their SQL where there is some."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from stakescore import staging
from stakescore.llm import ann, byte_bpe, digest_index, language, license_scan, line_dedup, oracle, packing, simhash, token_files, toxicity, vector_codes, warc, whitening
from stakescore.llm.workers import prepare

Query = Callable[[SparkSession, str], DataFrame]

BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_token_files(spark, sf_dir):
    path = staging.staging_path(spark, "token-files")
    token_files.write(_documents(spark, sf_dir), path, WORD_TOKENIZER, end_id=2)
    return token_files.read(spark, path)


def op2_simhash(spark, sf_dir):
    return simhash.near_duplicates(_documents(spark, sf_dir), width=4, radius=4)


def op3_byte_bpe(spark, sf_dir):
    return byte_bpe.digests(_documents(spark, sf_dir), BYTE_RANKS, public_tokenizers.PATTERN)


def op4_language_id(spark, sf_dir):
    return language.language_id(_documents(spark, sf_dir))


def op5_toxicity(spark, sf_dir):
    return toxicity.toxicity(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_license_scan(spark, sf_dir):
    """Documents have no paths, so each gets one from its source, language and number."""
    files = _documents(spark, sf_dir).select(F.expr(oracle.DOCUMENT_PATH).alias("path"), "text")
    # The path of a null doc_id ends in its folder.
    doc_id = F.regexp_extract("path", "(?:^|/)(?:LICENSE|file)[.](-?[0-9]+)$", 1).try_cast("bigint")
    return license_scan.licences(files).withColumn("doc_id", doc_id)


def op7_line_dedup(spark, sf_dir):
    """The source of a document is its host."""
    cut = line_dedup.drop_boilerplate(_documents(spark, sf_dir), "source")
    return cut.select("doc_id", "source", F.col("n_lines").cast("bigint"), F.col("n_dropped").cast("bigint"), F.sha2("text", 256).alias("text_sha256"))


def op8_exact_dedup(spark, sf_dir):
    index = digest_index.DigestIndex(spark, staging.staging_path(spark, "digest-index"))
    return digest_index.exact_duplicates(_documents(spark, sf_dir), index)


def op9_nearest_neighbours(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ann.nearest(vectors, F.col("vec_id") % 20 == 0, k=20, vector="embedding")


def op10_best_fit_packing(spark, sf_dir):
    return packing.best_fit(packing.pieces(_documents(spark, sf_dir), WORD_TOKENIZER, end_id=1, capacity=4096), 4096)


def op11_vector_codes(spark, sf_dir):
    return vector_codes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_whitening(spark, sf_dir):
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_warc(spark, sf_dir):
    path = staging.staging_path(spark, "warc")
    warc.write(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    found = warc.digests(warc.captures(warc.records(spark, path), payload=False))
    return found.select(
        F.col("key").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("bigint"))


def pipeline(spark, sf_dir):
    import corpus_pipeline  # beside the package, and imports it

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_token_files": op1_token_files,
    "op2_simhash": op2_simhash,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_language_id": op4_language_id,
    "op5_toxicity": op5_toxicity,
    "op6_license_scan": op6_license_scan,
    "op7_line_dedup": op7_line_dedup,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_vector_codes": op11_vector_codes,
    "op12_whitening": op12_whitening,
    "op13_warc": op13_warc,
    "pipeline": pipeline,
}


def registered() -> dict[str, Query]:
    def wrap(query: Query) -> Query:
        def run(spark, sf_dir):
            prepare(spark)
            return query(spark, sf_dir)

        return run

    return {name: wrap(query) for name, query in QUERIES.items()}


def statements() -> dict[str, str]:
    return oracle.statements()
