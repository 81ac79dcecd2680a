"""S4 as a stream: finished runs arrive as files and are appended to the history table.

Each micro-batch is written with the same month-partitioned append as the batch
path (``history.append_runs``), named by the stream and the batch number, so a
batch that is replayed after a crash replaces its first copy; the stream's
progress lives in a checkpoint under the shared ``spark.checkpoint.dir``.  Counters and latest values stay aggregates over the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablelens.operators.history import append_runs
from tablelens.session import checkpoint_dir


def ingest_runs(spark: SparkSession, source_dir: str, schema: T.StructType | str, history_path: str,
                name: str = "history-ingest", available_now: bool = True):
    """Start (and, with ``available_now``, finish) the stream from ``source_dir`` into ``history_path``."""
    stream: DataFrame = spark.readStream.schema(schema).parquet(source_dir)
    ckpt = f"{checkpoint_dir(spark).rstrip('/')}/{name}"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        append_runs(batch, history_path, f"{name}-{batch_id}")

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query
