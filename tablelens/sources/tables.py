"""Parquet table access for the test-data layout (one ``<name>.parquet`` per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


_READERS: dict = {}
_REGISTERED: dict = {}


def _session(spark: SparkSession) -> tuple:
    """A name for the session that no later session gets: its application, and its number in it."""
    return spark.sparkContext.applicationId, spark._jsparkSession.hashCode()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it.

    The relation (file listing and footer schema) is resolved once per session
    and reused by every query.
    """
    key = (*_session(spark), sf_dir.rstrip("/"), name)
    df = _READERS.get(key)
    if df is None:
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        _READERS[key] = df
    return df


def register_tables(spark: SparkSession, sf_dir: str, names=None) -> None:
    """Register the tables as temp views (scans stay lazy until an action)."""
    for name in names or TABLES:
        key = (*_session(spark), name)
        src = sf_dir.rstrip("/")
        if _REGISTERED.get(key) == src and spark.catalog.tableExists(name):
            continue
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
        _REGISTERED[key] = src
