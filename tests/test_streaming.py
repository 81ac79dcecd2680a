"""Streaming ingestion of runs gives the same history as the batch append."""

import uuid

from pyspark.sql import functions as F

from tablelens.operators import history as H
from tablelens.plans.fixtures import fixture
from tablelens.session import checkpoint_dir
from tablelens.streaming.history_ingest import ingest_runs

SF = "/root/testdata/sf0.001"


def test_stream_ingest_matches_batch(spark):
    runs = fixture(spark, SF, "f8")
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    src = f"{base}/incoming"
    cut = F.lit("1995-01-01").cast("timestamp_ntz")
    runs.filter(F.col("ts") < cut).write.parquet(f"{src}/part1")
    runs.filter(F.col("ts") >= cut).write.parquet(f"{src}/part2")
    ingest_runs(spark, f"{src}/*", runs.schema, f"{base}/history", name=f"ingest-{uuid.uuid4().hex}")
    streamed = H.latest_per_dataset(spark.read.parquet(f"{base}/history"), ["run_id", "best_model", "best_score"])
    batch = H.latest_per_dataset(runs, ["run_id", "best_model", "best_score"])
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    assert spark.read.parquet(f"{base}/history").count() == runs.count()
