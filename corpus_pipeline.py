"""A training corpus from `documents`: five stages, each a table that the next one reads.

Toxic documents go, one document of each group of near-duplicates stays, secrets are replaced in
the texts, sources are mixed to their target weights, and the texts are encoded into pieces.

Every stage takes columns of any name beside those of documents, and all but the last pass them on; the second
compares whole rows by a hash and so takes no maps. An empty table gives an empty table. The module needs tradeflow.llm; __spark_entry__.py leaves it out where that cannot be imported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradeflow.llm import mixing, pieces, secrets, simhash, toxicity
from tradeflow.llm.common import documents, written


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject.

    A null or empty text is judged by the thresholds alone; repeated rows go or stay together.
    """
    labels = toxicity.labelled(documents(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, labels)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Texts without words are near-duplicates of one another; of rows that share the smallest id, one stays. Rows
    without an id stay only where the group has no other.
    """
    return simhash.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced; a null text stays null."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Documents without words are not taken; a null source is a source of its own; rows without an id draw by
    their text.
    """
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of ids, and hashes of ids and decoded text of every document of the mix.

    Copies of a document are encoded alike, one row each; a null text is an empty one.
    """
    return pieces.encoded(docs)


STAGES = [
    ("toxicity", keep_clean),
    ("simhash", keep_distinct),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

# Classifier, fingerprints and pieces have no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written before the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
