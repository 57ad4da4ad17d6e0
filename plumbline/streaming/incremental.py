"""Incremental, idempotent processing with Structured Streaming, and event-time windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def append_new(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, key: str, step: Callable[[DataFrame], DataFrame] = lambda d: d, fmt: str = "csv", options: dict | None = None) -> StreamingQuery:
    """Files that have arrived since the last run, each id once, the first one seen counts; ends when all are done.

    The checkpoint holds the files and ids that were seen, so a stopped run goes on where it was and a second one adds nothing.
    """
    options = {"header": "true", "escape": '"'} | (options or {}) if fmt == "csv" else options or {}
    rows = spark.readStream.schema(schema).format(fmt).options(**options).load(source)
    out = step(rows.dropDuplicates([key]))
    return out.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def within_watermark(events: DataFrame, ts: str, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """Duplicates within the watermark go; state is bounded by it."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def windowed(events: DataFrame, ts: str, keys: list[str], value: str, length: str, slide: str | None = None, late: str | None = None) -> DataFrame:
    """Tumbling or sliding windows: (start, keys, n, total). Works on batches and, with a watermark, on streams."""
    rows = events.withWatermark(ts, late) if late else events
    w = F.window(ts, length, slide) if slide else F.window(ts, length)
    return rows.groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(value), 4).alias("total")).select(F.col("w.start").alias("start"), *keys, "n", "total")


def sessions(events: DataFrame, ts: str, keys: list[str], quiet: str, late: str | None = None) -> DataFrame:
    """Session windows: (keys, start, end, n); a session ends after a quiet time."""
    rows = events.withWatermark(ts, late) if late else events
    grouped = rows.groupBy(F.session_window(ts, quiet).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.max(ts).alias("last"))
    return grouped.select(*keys, F.col("w.start").alias("start"), F.col("last").alias("end"), "n")
