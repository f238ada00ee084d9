"""Entity lookups: one plan answers for a single entity or for all of them.

An unknown id gives no row; a known entity without events gives a row of zeros.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyworks.functions import measures as m
from tallyworks.operators.keyed import newest_per_key


def _only(df: DataFrame, key: str, value) -> DataFrame:
    return df if value is None else df.filter(F.col(key) == value)


def campaign_performance(events: DataFrame, campaigns: DataFrame, campaign_id: int | None = None) -> DataFrame:
    """Impressions, clicks, click share and spend; campaigns without events are kept."""
    totals = (
        _only(events, "campaign_id", campaign_id).groupBy("campaign_id")
        .agg(
            F.count("event_id").alias("impressions"),
            m.true_count("was_clicked").alias("clicks"),
            F.sum("ad_cost").alias("cost"),
        )
    )
    wanted = _only(campaigns.select("campaign_id", "campaign_name"), "campaign_id", campaign_id)
    return wanted.join(totals, "campaign_id", "left").select(
        "campaign_id", "campaign_name",
        m.count_or_zero("impressions").alias("impressions"),
        m.count_or_zero("clicks").alias("clicks"),
        m.ctr_share("clicks", "impressions").alias("ctr"),
        m.money_or_zero("cost").alias("total_ad_spend"),
    )


def advertiser_spending(
    events: DataFrame, campaigns: DataFrame, advertisers: DataFrame, advertiser_id: int | None = None
) -> DataFrame:
    """Spend, impressions, clicks and revenue over all campaigns of an advertiser; zeros are kept.

    For one advertiser only the events of its campaigns are aggregated.
    """
    if advertiser_id is not None:
        own = _only(campaigns, "advertiser_id", advertiser_id).select("campaign_id")
        events = events.join(own, "campaign_id", "left_semi")
    per_campaign = (
        events.groupBy("campaign_id")
        .agg(
            F.sum("ad_cost").alias("cost"),
            F.count("event_id").alias("impressions"),
            m.true_count("was_clicked").alias("clicks"),
            F.sum("ad_revenue").alias("revenue"),
        )
    )
    owned = _only(campaigns.select("campaign_id", "advertiser_id"), "advertiser_id", advertiser_id)
    per_advertiser = (
        owned.join(per_campaign, "campaign_id")
        .groupBy("advertiser_id")
        .agg(*[F.sum(c).alias(c) for c in ("cost", "impressions", "clicks", "revenue")])
    )
    wanted = _only(advertisers.select("advertiser_id", "name"), "advertiser_id", advertiser_id)
    return wanted.join(per_advertiser, "advertiser_id", "left").select(
        "advertiser_id", F.col("name").alias("advertiser_name"),
        m.money_or_zero("cost").alias("total_ad_spend"),
        m.count_or_zero("impressions").alias("total_impressions"),
        m.count_or_zero("clicks").alias("total_clicks"),
        m.money_or_zero("revenue").alias("total_ad_revenue"),
    )


def user_engagements(
    events: DataFrame, campaigns: DataFrame, advertisers: DataFrame, users: DataFrame,
    user_id: int | None = None, n: int = 50,
) -> DataFrame:
    """The newest `n` events of each known user with campaign and advertiser names.

    Names are joined first, because only events with a known campaign may take one of the n places. Users are checked
    last, on at most n rows each.
    """
    owned = campaigns.select("campaign_id", "advertiser_id", "campaign_name")
    named = owned.join(
        advertisers.select("advertiser_id", F.col("name").alias("advertiser_name")), "advertiser_id"
    )
    mine = _only(events, "user_id", user_id).filter(F.col("user_id").isNotNull())
    listed = mine.join(named, "campaign_id").select(
        "user_id", "event_id", "campaign_name", "advertiser_name", "timestamp", "was_clicked",
        "click_timestamp", "ad_cost", "ad_revenue",
    )
    newest = newest_per_key(listed, ["user_id"], [F.desc("timestamp"), F.asc("event_id")], n)
    return newest.join(_only(users.select("user_id"), "user_id", user_id), "user_id", "left_semi")


def user_engagement_counts(
    events: DataFrame, campaigns: DataFrame, advertisers: DataFrame, users: DataFrame,
    user_id: int | None = None, n: int = 50,
) -> DataFrame:
    """How many events `user_engagements` lists per user: those of a known campaign and advertiser.

    A known user without events has a row with 0, an unknown user none: that tells the two apart. Events are summed per
    user and campaign before campaigns are checked, so neither a hot user nor a hot campaign is shuffled row by row.
    """
    known = campaigns.join(advertisers.select("advertiser_id"), "advertiser_id", "left_semi").select("campaign_id")
    totals = (
        _only(events, "user_id", user_id).groupBy("user_id", "campaign_id").agg(m.rows().alias("events"))
        .join(known, "campaign_id", "left_semi")
        .groupBy("user_id").agg(F.sum("events").alias("events"))
    )
    return _only(users.select("user_id"), "user_id", user_id).join(totals, "user_id", "left").select(
        "user_id", F.least(m.count_or_zero("events"), F.lit(n).cast("bigint")).alias("engagements")
    )
