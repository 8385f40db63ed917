"""The stateless artifact checks over documents as they arrive, and windowed event counts (additions)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrove.operators.quality import repeated_word_issues


def stream_issues(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A stream of repeated-word issues of the documents in a folder's parquet files."""
    return repeated_word_issues(spark.readStream.schema(schema).parquet(folder), "doc_id", "text")


def stream_event_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events per window and type; rows later than the watermark are left out."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"))
