"""One query for each operator, over whole tables with the parameters meant for production."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, langid, line_dedup, minhash_dedup, mixture, paragraph_dedup, periodic_runs, personal_data, quality, spelling_variants, suffix_dedup, token_files, toxicity
from ledgerloom.llm.sql import SQL

__all__ = ["QUERIES", "SQL"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.references(docs))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.learn(docs))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``kept``: the whole text stays."""
    return suffix_dedup.dedup(table(spark, sf_dir, "documents")).drop("kept_bytes").withColumn("kept", F.col("n_removed") == 0)


def op7_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.dedup(table(spark, sf_dir, "documents"), paragraph_dedup.Settings(whole_lines=True)).drop("kept_text")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encode_table(table(spark, sf_dir, "documents"), tokenizer_file(), end_id=2)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(table(spark, sf_dir, "documents"))


def repeated_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """The places of a text's words where every tenth document or so repeats a piece of itself to the end."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return places


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.summary(periodic_runs.find(table(spark, sf_dir, "documents"), reorder=repeated_tail))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.summary(personal_data.find(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_line_dedup, op2_near_dedup, op3_mix, op4_quality, op5_language, op6_suffix_dedup, op7_paragraphs, op8_decontaminate, op9_token_files, op10_toxicity, op11_spelling_variants, op12_periodic_runs, op13_personal_data)
}
