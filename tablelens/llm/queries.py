"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablelens.llm import chat, decontam, langid, merkle, mixing, quality, recurrent, search, simhash, spelling, substring, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document against the whole benchmark."""
    return decontam.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("spans")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 5, 2, 1 (repeating) by source, at most three epochs of any."""
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from labels.quality."""
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat as part of 200-byte strings, and the digest of the rest."""
    return substring.digests(_table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document (3-word shingles, 2 bits)."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document and the spans of each language."""
    return langid.identify(_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived as a WARC record and read back; equal payloads as revisits."""
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every maximal conversation, rendered."""
    return chat.render(_table(spark, sf_dir, "conversations"))


def op9_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and likeness to those and to the next document."""
    return merkle.compare_with_edits(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document by its nearest labelled examples."""
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its more frequent spelling and the root of its chain."""
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under a recurrent model and under token counts."""
    return recurrent.score_all(_table(spark, sf_dir, "documents"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return search.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_mixing": op2_mixing,
    "op3_quality": op3_quality,
    "op4_substring": op4_substring,
    "op5_simhash": op5_simhash,
    "op6_language": op6_language,
    "op7_warc": op7_warc,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_merkle": op9_merkle,
    "op10_toxicity": op10_toxicity,
    "op11_spelling": op11_spelling,
    "op12_language_model": op12_language_model,
    "op13_search": op13_search,
}
ORACLES = {
    "op1_decontamination": decontam.ORACLE,
    "op2_mixing": mixing.ORACLE.format(docs="documents"),
    "op7_warc": warc.ORACLE,
    "op8_chat_formatting": chat.ORACLE,
    "op9_merkle": merkle.ORACLE,
    "op11_spelling": spelling.ORACLE,
    "op13_search": search.ORACLE,
}
