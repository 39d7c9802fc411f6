"""Registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import alignment, bpe, chaining, fingerprints, language, licenses, merkle, mixing, quality, repeats, secrets, simhash, vptree
from .common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op3_shared_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.passages(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.token_digests(table(spark, sf_dir, "documents"), tokenizer_path(), public_tokenizers.PATTERN)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known_licenses(spark))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=2)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprinted(table(spark, sf_dir, "documents"))


def op7_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vptree.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.token_links(table(spark, sf_dir, "documents"), *paths, public_tokenizers.PATTERN)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_shared_passages": op3_shared_passages,
    "op4_secret_scan": op4_secret_scan,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_fingerprints": op6_fingerprints,
    "op7_nearest_vectors": op7_nearest_vectors,
    "op8_source_mix": op8_source_mix,
    "op9_language_id": op9_language_id,
    "op10_quality_rules": op10_quality_rules,
    "op11_token_alignment": op11_token_alignment,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_repeated_strings": op13_repeated_strings,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {"op1_license_scan": licenses.oracle_sql(), "op12_merkle_manifest": merkle.oracle_sql()}
