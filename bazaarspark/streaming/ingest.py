"""Landed files as a stream into staging, and windowed measures over events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bazaarspark.operators.quality import Split
from bazaarspark.sources.landing import from_text
from bazaarspark.sources.store import load_staging


def landed_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """New JSON-lines files of a folder as text lines."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)


def stream_to_staging(
    lines: DataFrame,
    normalize: Callable[[DataFrame], Split],
    table: str,
    folder: str,
    checkpoint: str,
    database: str = "default",
) -> StreamingQuery:
    """Normalise each micro-batch, upsert the good rows and append the dead letters.

    Upserts are idempotent and dead letters carry the batch number, so a batch that is retried after a
    failure changes nothing twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        # Good and dead rows both come from the batch: it is read once.
        batch.persist()
        try:
            parts = normalize(from_text(batch))
            load_staging(batch.sparkSession, table, parts.good, folder, database)
            parts.dead.write.mode("overwrite").parquet(f"{folder}/dead_letters/{table}/batch={number}")
        finally:
            batch.unpersist()

    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def without_repeats(events: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """Events once per key within the watermark; state is dropped as the watermark passes."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def windowed_measures(events: DataFrame, time: str = "ts", length: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Count and value per event type and tumbling window; late rows beyond `delay` are left out."""
    return (
        events.withWatermark(time, delay)
        .groupBy(F.window(time, length).alias("window"), "event_type")
        .agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value"))
        .select(F.col("window.start").alias("start"), "event_type", "events", "value")
    )


def session_measures(events: DataFrame, time: str = "ts", gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Sessions of a user: events closer than `gap`."""
    return (
        events.withWatermark(time, delay)
        .groupBy("user_id", F.session_window(time, gap).alias("session"))
        .agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value"))
        .select("user_id", F.col("session.start").alias("start"), F.col("session.end").alias("end"), "events", "value")
    )
