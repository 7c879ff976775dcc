"""Incremental ingest of documents as chunks, with late and repeated rows handled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def new_chunks(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Chunks (id, text, ts) once each within the watermark."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["id"])


def counts(stream: DataFrame, key: str, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Rows per key and tumbling window; a window closes when the watermark passes it."""
    return stream.withWatermark("ts", delay).groupBy(F.window("ts", window).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def append(chunks: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return chunks.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
