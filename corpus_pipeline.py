"""From raw documents to token files: five stages, each written as Parquet before the next reads it.

No stage can be put in SQL as a whole (trained classifier, MinHash, SimHash,
tokenizer), so there is no ``ORACLE_SQL``; ``tests/llm`` holds a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import decontaminate, minhash_dedup, mixture, token_files, toxicity
from ledgerloom.llm.queries import table, tokenizer_file
from ledgerloom.llm.shared import kept


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic; trained on the labelled rows of the stage's input."""
    return toxicity.remove(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest doc_id."""
    return minhash_dedup.dedup(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with a benchmark item."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each use of a document in the mix."""
    return mixture.materialise(docs, mixture.mix(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as read back from the token files; uses of one document stay rows of their own."""
    return token_files.encode_table(docs, tokenizer_file(), end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("source_weights", weights),
    ("token_files", token_ids),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reading what its predecessor wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
