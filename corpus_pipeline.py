"""The corpus pipeline: quality, near-duplicates, secrets, mixing, tokens.

Every stage takes the documents its predecessor kept, written as Parquet and read again, and all but the last
return the columns of ``documents``. No stage can be written as SQL: a model is trained in the first, and the
last runs a tokenizer. The tests hold each stage against a plain form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logweir.llm import bpe, mixing, quality, secrets, simhash
from logweir.llm.common import small_batches, staged, table
from logweir.llm.queries import tokenizer_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. NULL and empty texts, repeated rows and rows without an id are scored like
    others, by what their text holds; without any labels nothing is rejected."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are alike by 0.8 or more: the one with the smallest id.

    A NULL text counts as empty. Rows with the same id and text are one document; texts that share an id, or have none, are
    documents of their own, chosen after all others by id (NULL last) and digest. An empty table stays one; very long texts
    are compared whole.
    """
    return simhash.kept_documents(docs, words=5, radius=36, alike=0.8)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets blotted out, however long the text. A NULL text stays NULL, repeated rows are each
    treated, an empty table stays one."""
    return secrets.redacted(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document. NULL is a source of its own; repeated rows are documents of their own;
    a row without words is in the mix like any other; the document in which a quota ends gives its first words."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every row: how many, the digest of the ids and of the bytes they decode to. A NULL text counts as
    empty and has none; repeated rows each give a row."""
    import public_tokenizers

    small_batches(spark)
    return bpe.token_digests(docs, tokenizer_path(), public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("secrets", secret_scan),
    ("mixing", source_mix),
    ("tokens", token_ids),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
