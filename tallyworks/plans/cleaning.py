"""Typed frames from raw text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyworks.functions import parsing as p

# Columns a review must have. The keyed tables also need the customer; the statistics do not.
REVIEW_REQUIRED = ("review_id", "product_id", "star_rating", "review_date")
REVIEW_KEYED_REQUIRED = (*REVIEW_REQUIRED, "customer_id")


def computed_once(raw: DataFrame, *columns: str) -> DataFrame:
    """The named columns as plain values.

    Parsers name their input several times, and filters name what they give. Where the input is itself an expression, Spark
    would paste it in each time, up to methods too long to compile. `inline` is a step that nothing is pasted through.
    """
    return raw.select(F.inline(F.array(F.struct(*(columns or raw.columns)))))


def clean_events(raw: DataFrame, time_formats: Sequence[str] = ()) -> DataFrame:
    """Typed ad events, one row per raw row. Times are read in ISO form, then in `time_formats` in their order.

    Null names stay null. `event_id` is the text as given; the generated replacement of a bad one is made
    where ids are stored. Events without a readable timestamp stay, with a null `event_date`: the
    per-user and per-region totals count them.
    """
    typed = raw.select(
        p.clean_text("EventID").alias("event_id"),
        p.clean_text("AdvertiserName").alias("advertiser_name"),
        p.clean_text("CampaignName").alias("campaign_name"),
        p.clean_text("CampaignTargetingCountry").alias("target_country"),
        p.whole_number("UserID", "bigint").alias("user_id"),
        p.clean_text("Location").alias("location"),
        p.clean_text("Device").alias("device"),
        p.clean_text("AdSlotSize").alias("ad_slot_size"),
        p.wall_clock_of("Timestamp", time_formats).alias("event_timestamp"),
        p.decimal_or_null("BidAmount", 10, 2).alias("bid_amount"),
        p.money("AdCost").alias("ad_cost"),
        p.flag("WasClicked").alias("was_clicked"),
        p.wall_clock_of("ClickTimestamp", time_formats).alias("click_timestamp"),
        p.money("AdRevenue").alias("ad_revenue"),
    )
    return typed.withColumn("event_date", F.to_date("event_timestamp"))


def clean_reviews(raw: DataFrame) -> DataFrame:
    """Reviews with all required columns, a readable date and a rating of 1 to 5.

    A row whose date is present but unreadable is dropped, so that none ends up under a null month.
    """
    typed = _typed_reviews(raw.dropna(subset=list(REVIEW_KEYED_REQUIRED)))
    return typed.filter(F.col("star_rating").between(1, 5))


def clean_verified_reviews(raw: DataFrame) -> DataFrame:
    """Verified purchases for the statistics: no check of the rating range, the customer may be missing."""
    typed = _typed_reviews(raw.dropna(subset=list(REVIEW_REQUIRED)))
    return typed.filter(F.col("verified_purchase") == 1)


def _typed_reviews(raw: DataFrame) -> DataFrame:
    text = ["review_id", "product_id", "customer_id", "marketplace", "product_title", "product_category",
            "review_headline", "review_body"]
    whole = ["star_rating", "helpful_votes", "total_votes", "vine", "verified_purchase"]
    return computed_once(raw, *text, *whole, "review_date").select(
        *text,
        *[p.whole_number(c).alias(c) for c in whole],
        p.iso_date("review_date").alias("review_date"),
    ).filter(F.col("review_date").isNotNull())


def clean_users(raw: DataFrame) -> DataFrame:
    return raw.select(
        p.whole_number("UserID", "bigint").alias("user_id"),
        p.whole_number("Age", "smallint").alias("age"),
        p.clean_text("Gender").alias("gender"),
        p.clean_text("Location").alias("location"),
        F.col("Interests").alias("interests"),
        p.iso_date("SignupDate").alias("signup_date"),
    ).filter(F.col("user_id").isNotNull())


def clean_campaigns(raw: DataFrame) -> DataFrame:
    return raw.select(
        p.whole_number("CampaignID", "bigint").alias("campaign_id"),
        p.clean_text("AdvertiserName").alias("advertiser_name"),
        p.clean_text("CampaignName").alias("campaign_name"),
        p.iso_date("CampaignStartDate").alias("start_date"),
        p.iso_date("CampaignEndDate").alias("end_date"),
        p.clean_text("TargetingCriteria").alias("targeting_criteria"),
        p.slot_size("AdSlotSize").alias("slot"),
        p.money("Budget", 14, 2).alias("budget"),
    )
