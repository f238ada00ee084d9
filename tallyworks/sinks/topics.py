"""Publishing rows as JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tallyworks.functions.serialise import as_message


def messages(df: DataFrame, *columns: Column | str) -> DataFrame:
    """One JSON message per row, of all columns unless some are named."""
    return df.select(as_message(*(columns or df.columns)))


def publish(df: DataFrame, folder: str) -> None:
    """Append a batch of messages to a topic folder."""
    messages(df).write.mode("append").text(folder)


def publish_kafka(df: DataFrame, servers: str, topic: str) -> None:
    (
        messages(df).write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
