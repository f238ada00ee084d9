"""Message topics as streams of one text column `value`.

A topic is a folder of JSON-lines files, or a Kafka topic where that connector is on the class path.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_topic(
    spark: SparkSession,
    folder: str,
    starting: str | datetime = "earliest",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream a topic folder.

    `starting` is "earliest", "latest" (from now on) or an instant: only files written after it are taken.
    A query that is to be restarted should be given an instant, and the same one again on restart; its
    checkpoint then decides what is still to be read.
    """
    if starting == "latest":
        starting = datetime.now(timezone.utc)
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    lines = reader.load(folder)
    if starting == "earliest":
        return lines.select("value")
    written = F.col("_metadata.file_modification_time")
    return lines.filter(written > F.lit(starting)).select("value")


def read_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "latest") -> DataFrame:
    """The same stream from Kafka; lost offsets are skipped and not fatal."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", "false")
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )
