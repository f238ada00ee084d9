"""The page-creation chain: topic `input` -> filter -> topic `processed` -> keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyworks.plans.pages import ALLOWED_DOMAINS, PAGE_KEY, filter_page_creates, page_creates
from tallyworks.sinks.topics import messages
from tallyworks.schemas import PAGE_CREATE
from tallyworks.sources.intake import parse_events, split_keyed
from tallyworks.sources.topics import read_topic
from tallyworks.streaming.keyed_table import BATCH, FOLD_EVERY, RUN, read_latest, stream_upsert

_NOW = {"availableNow": True}


def stream_publish(df: DataFrame, folder: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Publish a streaming frame as JSON messages to a topic folder, each exactly once."""
    writer = messages(df).writeStream.format("text").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or _NOW)).start(folder)


def stream_publish_kafka(
    df: DataFrame, servers: str, topic: str, checkpoint: str, **trigger
) -> StreamingQuery:
    writer = (
        messages(df).writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    return writer.trigger(**(trigger or _NOW)).start()


def stream_filter(
    input_messages: DataFrame, processed: str, checkpoint: str,
    domains: Sequence[str] = ALLOWED_DOMAINS, **trigger,
) -> StreamingQuery:
    """First hop. Stateless, no shuffle."""
    return stream_publish(filter_page_creates(input_messages, domains), processed, checkpoint, **trigger)


def stream_malformed(input_messages: DataFrame, folder: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Messages that are no JSON, with the reason, which the first hop leaves out."""
    bad = parse_events(input_messages, PAGE_CREATE)[1]
    writer = bad.writeStream.format("json").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or _NOW)).start(folder)


def stream_pages(
    processed_messages: DataFrame, table: str, checkpoint: str, quarantine: str | None = None,
    fold_every: int | None = FOLD_EVERY, count: bool = False, **trigger,
) -> StreamingQuery:
    """Second hop: typed rows into the keyed table; rows without a full key go to `quarantine`."""
    return stream_upsert(
        page_creates(processed_messages), table, PAGE_KEY, ["user_id"], checkpoint,
        split=lambda rows: split_keyed(rows, *PAGE_KEY), quarantine=quarantine, fold_every=fold_every, count=count, **trigger,
    )


def read_pages(spark: SparkSession, table: str) -> DataFrame:
    """The last write of every page; within a batch the highest user id."""
    return read_latest(spark, table, PAGE_KEY, [RUN, BATCH, "user_id"])


def run_chain(
    spark: SparkSession, input_messages: DataFrame, root: str, domains: Sequence[str] = ALLOWED_DOMAINS
) -> DataFrame:
    """Run both hops over what is there now, each with its own checkpoint, and read the table.

    Malformed messages go to `malformed`, rows without a full key to `quarantine`.
    Running it again with more input continues where the checkpoints left off.
    """
    processed, table = f"{root}/processed", f"{root}/page_creates"
    stream_filter(input_messages, processed, f"{root}/ckpt/filter", domains).awaitTermination()
    stream_malformed(input_messages, f"{root}/malformed", f"{root}/ckpt/malformed").awaitTermination()
    stream_pages(
        read_topic(spark, processed), table, f"{root}/ckpt/pages", f"{root}/quarantine"
    ).awaitTermination()
    return read_pages(spark, table)
