"""Daily click and impression counters per campaign, kept up to date by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyworks.functions import measures as m
from tallyworks.functions.calendar import utc_date, utc_instant
from tallyworks.streaming.keyed_table import read_latest, stream_upsert

COUNTER_KEY = ("campaign_name", "event_date")


def daily_counters(events: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Impressions and clicks per campaign and day; on a batch frame the watermark has no effect.

    Counts are partially summed before the shuffle, so a hot campaign costs one state update per task. The
    watermark lets finished days leave the state; a row later than it is dropped.
    """
    timed = events.withColumn("_at", utc_instant("event_timestamp"))
    return (
        timed.withWatermark("_at", watermark)
        .groupBy("campaign_name", F.window("_at", "1 day").alias("_day"))
        .agg(m.rows().alias("impressions"), m.true_count("was_clicked").alias("clicks"))
        .select(
            "campaign_name", utc_date("_day.start").alias("event_date"), "impressions", "clicks"
        )
    )


def stream_daily_counters(
    events: DataFrame, table: str, checkpoint: str, watermark: str = "1 day", **trigger
) -> StreamingQuery:
    """Each batch emits the new totals of the counters it touched; the keyed table keeps the latest."""
    return stream_upsert(
        daily_counters(events, watermark), table, COUNTER_KEY, ["impressions"], checkpoint,
        mode="update", **trigger,
    )


def read_counters(spark: SparkSession, table: str) -> DataFrame:
    return read_latest(spark, table, COUNTER_KEY)
