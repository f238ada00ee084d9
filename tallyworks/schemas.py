"""Explicit schemas of every raw input and message. Raw file columns stay text until cleaned."""

from __future__ import annotations

from pyspark.sql import types as T


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


AD_EVENTS_RAW = _text(
    "EventID", "AdvertiserName", "CampaignName", "CampaignTargetingCountry", "UserID", "Location",
    "Device", "AdSlotSize", "Timestamp", "BidAmount", "AdCost", "WasClicked", "ClickTimestamp", "AdRevenue",
)

USERS_RAW = _text("UserID", "Age", "Gender", "Location", "Interests", "SignupDate")

CAMPAIGNS_RAW = _text(
    "CampaignID", "AdvertiserName", "CampaignName", "CampaignStartDate", "CampaignEndDate",
    "TargetingCriteria", "AdSlotSize", "Budget",
)

REVIEWS_RAW = _text(
    "marketplace", "customer_id", "review_id", "product_id", "product_title", "product_category",
    "star_rating", "helpful_votes", "total_votes", "vine", "verified_purchase", "review_headline",
    "review_body", "review_date",
)

PAGE_CREATE = T.StructType([
    T.StructField("meta", T.StructType([
        T.StructField("domain", T.StringType()),
        T.StructField("dt", T.StringType()),
    ])),
    T.StructField("page_title", T.StringType()),
    T.StructField("performer", T.StructType([
        T.StructField("user_id", T.LongType()),
        T.StructField("user_is_bot", T.BooleanType()),
    ])),
])

PROCESSED = T.StructType([
    T.StructField("domain", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("page_title", T.StringType()),
    T.StructField("user_id", T.LongType()),
])

TWEET = _text("customer_id", "review_date", "review_body")
