"""Rollups of cleaned ad events, and the queries over them.

Impressions count non-null event ids. Null names form a group of their own; null dates and null users
have no place in a table keyed by them and are left out of those tables only.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tallyworks.functions import measures as m
from tallyworks.functions.calendar import since_days
from tallyworks.functions.parsing import uuid_text
from tallyworks.operators import states as st
from tallyworks.operators.keyed import newest_per_key, one_per_key
from tallyworks.operators.ranking import rank_within, top_n

HISTORY_KEY = ("user_id", "event_timestamp", "event_id")
LAST_ADS = (*HISTORY_KEY, "campaign_name", "advertiser_name", "was_clicked", "click_timestamp")
EVERYONE = "global"  # the single bucket of the user ranking


def _impressions() -> Column:
    return F.count("event_id").alias("total_impressions")


def _clicks() -> Column:
    return m.true_count("was_clicked").alias("total_clicks")


def campaign_performance_by_day(events: DataFrame) -> DataFrame:
    """Impressions, clicks, click-through rate, cost and revenue of every campaign and day."""
    return (
        events.filter(F.col("event_date").isNotNull())
        .groupBy("campaign_name", "event_date")
        .agg(
            _impressions(), _clicks(),
            m.money_sum("ad_cost").alias("total_ad_cost"),
            m.money_sum("ad_revenue").alias("total_ad_revenue"),
        )
        .withColumn("ctr", m.ctr_daily("total_clicks", "total_impressions"))
        .select("campaign_name", "event_date", "total_impressions", "total_clicks", "ctr",
                "total_ad_cost", "total_ad_revenue")
    )


def campaign_day_rollup() -> st.Rollup:
    """The states behind `campaign_performance_by_day`, and the latest event of each campaign and day."""
    return st.Rollup(("campaign_name", "event_date"), {
        "total_impressions": st.counted("event_id"),
        "total_clicks": st.true_counted("was_clicked"),
        "total_ad_cost": st.money("ad_cost"),
        "total_ad_revenue": st.money("ad_revenue"),
        "last_event": st.newest("event_id", "event_timestamp"),
    }, where=F.col("event_date").isNotNull())


def campaign_performance_from_states(states: DataFrame) -> DataFrame:
    return states.select(
        "campaign_name", "event_date", "total_impressions", "total_clicks",
        m.ctr_daily("total_clicks", "total_impressions").alias("ctr"), "total_ad_cost", "total_ad_revenue",
        F.col("last_event.value").alias("last_event"))


def advertiser_spend_by_day(events: DataFrame) -> DataFrame:
    return (
        events.filter(F.col("event_date").isNotNull())
        .groupBy("advertiser_name", "event_date")
        .agg(
            m.money_sum("ad_cost").alias("total_spend"),
            _impressions(), _clicks(),
            m.money_sum("ad_revenue").alias("total_revenue"),
        )
    )


def user_engagement_history(events: DataFrame) -> DataFrame:
    """Every dated event of a known user, one row per user, timestamp and event id.

    A missing or malformed event id is replaced by one derived from the row. Copies of an event collapse,
    as in a store keyed this way; they do so in the map tasks already, so a much-copied event
    does not travel. The key also spreads the events of one busy user over all tasks.
    """
    return one_per_key(history_rows(events), HISTORY_KEY)


def history_rows(events: DataFrame) -> DataFrame:
    """The rows of the history as they come, copies included; of a stream as well."""
    known = events.filter(F.col("event_timestamp").isNotNull() & F.col("user_id").isNotNull())
    return known.select(
        "user_id",
        "event_timestamp",
        uuid_text("event_id", *known.columns).alias("event_id"),
        "campaign_name", "advertiser_name", "ad_slot_size", "device", "location",
        "was_clicked", "click_timestamp", "ad_cost", "ad_revenue",
    )


def user_activity(events: DataFrame) -> DataFrame:
    """Impressions, clicks and their sum per user; undated events count."""
    return (
        events.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(_impressions(), _clicks())
        .withColumn("total_interactions", F.col("total_impressions") + F.col("total_clicks"))
    )


def most_active_users(events: DataFrame) -> DataFrame:
    """All users ranked by interactions, ties by user id."""
    ranked = rank_within(user_activity(events), [], [F.desc("total_interactions"), "user_id"])
    return ranked.select(
        F.lit(EVERYONE).alias("activity_bucket"), "user_id", "total_interactions",
        "total_impressions", "total_clicks", "rank",
    )


def high_spending_advertisers_by_region(events: DataFrame) -> DataFrame:
    """Advertisers ranked by spend inside each targeted country; undated events count."""
    totals = (
        events.groupBy(F.col("target_country").alias("region"), "advertiser_name")
        .agg(
            m.money_sum("ad_cost").alias("total_spend"),
            _impressions(), _clicks(),
            m.money_sum("ad_revenue").alias("total_revenue"),
        )
    )
    return rank_within(totals, ["region"], [F.desc("total_spend"), "advertiser_name"])


# Queries over the rollups

def campaign_daily_history(by_day: DataFrame, campaign_name: str) -> DataFrame:
    """The days of one campaign, newest first."""
    return by_day.filter(F.col("campaign_name") == campaign_name).orderBy(F.desc("event_date"))


def top_advertisers_30d(by_day: DataFrame, as_of: date, n: int = 5, days: int = 30) -> DataFrame:
    """Top `n` advertisers by spend since `as_of - days`, re-aggregated from the daily rollup."""
    totals = (
        by_day.filter(since_days("event_date", as_of, days, is_date=True))
        .groupBy("advertiser_name")
        .agg(
            m.money_sum("total_spend").alias("total_30d_spend"),
            F.sum("total_impressions").alias("total_30d_impressions"),
            F.sum("total_clicks").alias("total_30d_clicks"),
            m.money_sum("total_revenue").alias("total_30d_revenue"),
        )
    )
    return top_n(totals, [F.desc("total_30d_spend"), "advertiser_name"], n)


def last_ads_per_user(history: DataFrame, user_id: int | None = None, n: int = 10) -> DataFrame:
    """The newest `n` ads of every user, or of one, with the click status."""
    if user_id is not None:
        history = history.filter(F.col("user_id") == user_id)
    newest = newest_per_key(history, ["user_id"], [F.desc("event_timestamp"), F.asc("event_id")], n)
    return newest.select(*LAST_ADS)


def top_clickers_30d(history: DataFrame, as_of: date, n: int = 10, days: int = 30) -> DataFrame:
    clicks = (
        history.filter(F.col("was_clicked") & since_days("event_timestamp", as_of, days))
        .groupBy("user_id")
        .agg(m.rows().alias("total_clicks_30d"))
    )
    return top_n(clicks, [F.desc("total_clicks_30d"), "user_id"], n)


def top_advertisers_region_30d(
    history: DataFrame, location: str, as_of: date, n: int = 5, days: int = 30
) -> DataFrame:
    """Top `n` advertisers by spend where the ad was seen.

    The region here is the place of the event, not the country the campaign was aimed at.
    """
    totals = (
        history.filter((F.col("location") == location) & since_days("event_timestamp", as_of, days))
        .groupBy("advertiser_name")
        .agg(m.money_sum("ad_cost").alias("total_30d_spend"))
    )
    return top_n(totals, [F.desc("total_30d_spend"), "advertiser_name"], n)
