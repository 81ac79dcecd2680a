"""Corpus pipeline: documents through five of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps with the
columns of ``documents`` (the last returns the mix).  Between stages the rows are
written as Parquet and read again, so a lost executor costs one stage's tasks.

Cases: every stage decides row by row, so null or repeated doc_ids are kept
apart; null texts pass toxicity (score of term-free texts), count as empty for
near duplicates, stay null in substring dedup and have no benchmark words; an
empty table goes through as an empty table; extra columns are carried up to the
mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelens.llm import decontam, mixing, simhash, substring, toxicity
from tablelens.llm.common import materialise


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored under 0.5 by their nearest labelled examples."""
    index = toxicity.fit(docs, _table(spark, sf_dir, "labels"), "toxic", 5, 0)
    return toxicity.keep_clean(docs, index)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of SimHash near duplicates: the smallest doc_id."""
    return simhash.deduplicate(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes inside repeated 200-byte strings; n_chars follows the new text."""
    cut = substring.cut_texts(docs)
    if "n_chars" not in cut.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(cut.schema["n_chars"].dataType))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that share no ten words in a row with the benchmark."""
    return decontam.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of every row."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]

#: Toxicity scores and XXH64 fingerprints have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
