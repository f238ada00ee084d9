"""Routing of short messages into one headed CSV folder per minute of the event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyworks.functions.parsing import wall_clock
from tallyworks.functions.serialise import text_or_empty
from tallyworks.schemas import TWEET
from tallyworks.sources.intake import parse_events, payload_state

FILE_COLUMN = "minute_file"


def minute_rows(messages: DataFrame, now: Column | None = None) -> DataFrame:
    """author_id, created_at, text of each message, with the name of its minute file.

    Missing author or text becomes an empty text, a missing time the processing time. The minute is the
    wall clock of the timestamp as written, whatever its offset. Texts that are no JSON and messages whose time cannot
    be read are left to `minute_quarantine`.
    """
    event, _ = parse_events(messages, TWEET)
    processed = F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    rows = event.select(
        text_or_empty("e.customer_id").alias("author_id"),
        F.coalesce(F.col("e.review_date"), processed).alias("created_at"),
        text_or_empty("e.review_body").alias("text"),
    )
    stamp = F.date_format(wall_clock("created_at"), "dd_MM_yyyy_HH_mm")
    named = rows.withColumn(FILE_COLUMN, F.concat(F.lit("tweets_"), stamp, F.lit(".csv")))
    return named.filter(F.col(FILE_COLUMN).isNotNull())


def minute_quarantine(messages: DataFrame) -> DataFrame:
    """value, reason of the messages that `minute_rows` leaves out; blank ones are skipped altogether."""
    readable = messages.filter(payload_state() == "good")
    time = F.from_json("value", TWEET)["review_date"]
    undated = readable.filter(time.isNotNull() & wall_clock(time).isNull()).select(
        "value", F.lit("unreadable time").alias("reason"))
    return parse_events(messages, TWEET)[1].unionByName(undated)


def bucket_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(FILE_COLUMN).agg(F.count(F.lit(1)).alias("rows"))


def stream_minute_files(
    messages: DataFrame, path: str, checkpoint: str, now: Column | None = None, **trigger
) -> StreamingQuery:
    """Append to the minute folders, each row exactly once.

    No shuffle: every task writes the minutes it sees, so a busy minute is written by many tasks.
    """
    return (
        minute_rows(messages, now).writeStream.format("csv")
        .option("header", True)
        .option("checkpointLocation", checkpoint)
        .partitionBy(FILE_COLUMN)
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )
