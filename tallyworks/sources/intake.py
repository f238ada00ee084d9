"""Message intake: blank payloads are skipped, malformed ones set aside, the rest parsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyworks.functions.parsing import clean_text


def payload_state(value: str = "value") -> Column:
    """`blank`, `malformed` or `good` for a message text."""
    text = clean_text(F.coalesce(F.col(value), F.lit("")))
    return (
        F.when(text == "", "blank")
        .when(F.try_parse_json(text).isNull(), "malformed")
        .otherwise("good")
    )


def parse_events(messages: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Split messages into parsed rows (struct column `e`) and a quarantine of unreadable texts.

    Both sides are lazy and work on a batch or a stream. A field of the wrong type is null in `e`; only
    text that is no JSON at all goes to quarantine.
    """
    marked = messages.withColumn("state", payload_state())
    good = marked.filter(F.col("state") == "good").select(F.from_json("value", schema).alias("e"))
    bad = marked.filter(F.col("state") == "malformed").select("value", F.lit("not JSON").alias("reason"))
    return good, bad


def intake_counts(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Messages per state and domain; a message that names no domain counts under `unknown`."""
    return (
        messages.select(
            payload_state().alias("state"),
            F.coalesce(F.from_json("value", schema)["meta"]["domain"], F.lit("unknown")).alias("domain"),
        )
        .groupBy("state", "domain")
        .agg(F.count(F.lit(1)).alias("messages"))
    )


def split_keyed(df: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """Rows that can be stored under their key, and the rows with a null in it."""
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    return df.filter(complete), df.filter(~complete)
