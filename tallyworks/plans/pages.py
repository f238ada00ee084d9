"""Page-creation events: filter and typed table. The same functions serve batch frames and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from tallyworks import schemas
from tallyworks.functions.parsing import instant
from tallyworks.operators.keyed import one_per_key

# The sites whose page creations are kept.
ALLOWED_DOMAINS = ("en.wikipedia.org", "www.wikidata.org", "commons.wikimedia.org")

PAGE_KEY = ("domain", "created_at", "page_title")


def _parsed(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """The fields of JSON messages, one row per message.

    Going through `inline` parses each message once: a filter on a parsed field stays above it, while
    on a plain projection Spark would push the filter down and parse again for every condition.
    """
    return messages.select(F.inline(F.array(F.from_json("value", schema))))


def filter_page_creates(messages: DataFrame, domains: Sequence[str] = ALLOWED_DOMAINS) -> DataFrame:
    """`value` messages of pages created by people on the given sites.

    An author whose bot flag is missing is not known to be a person and is left out. Unreadable
    messages parse to nulls and fail the filter.
    """
    flat = _parsed(messages, schemas.PAGE_CREATE).select(
        F.col("meta.domain").alias("domain"),
        F.col("meta.dt").alias("created_at"),
        F.col("page_title"),
        F.col("performer.user_id").alias("user_id"),
        F.col("performer.user_is_bot").alias("user_is_bot"),
    )
    return flat.filter(F.col("domain").isin(*domains) & (F.col("user_is_bot") == F.lit(False))).drop("user_is_bot")


def page_creates(messages: DataFrame) -> DataFrame:
    """Typed rows of processed messages: domain, created_at, page_title, user_id."""
    return _parsed(messages, schemas.PROCESSED).select(
        "domain", instant("created_at").alias("created_at"), "page_title", "user_id"
    )


def page_creates_table(rows: DataFrame) -> DataFrame:
    """One row per (domain, created_at, page_title); of several authors the highest id stays."""
    return one_per_key(rows, PAGE_KEY)
