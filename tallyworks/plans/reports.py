"""The campaign report: seven queries over the normalised advertising model.

Facts are filtered and aggregated by their own foreign key first; dimensions are joined to the few aggregated rows. A
campaign that owns a third of all events is one partial sum per task. A single query reads the facts once, with its
filter on the scan; the whole report reads them twice: once for the sums per campaign and once for those per
location, user and device.
Date bounds are inclusive; an inner join drops facts with a null or unknown key.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from tallyworks.functions import measures as m
from tallyworks.functions.calendar import in_window
from tallyworks.operators.ranking import top_n
from tallyworks.session import enable_checkpoints

TITLES = {
    "q1_top_campaigns_by_ctr": "Campaigns with the best click-through rate",
    "q2_advertiser_spending": "Advertisers with the highest spend",
    "q3_campaign_cpc_cpm": "Cost per click and per thousand impressions of every campaign",
    "q4_top_locations_by_revenue": "Locations with the highest click revenue",
    "q5_top_engaged_users": "Users with the most clicks",
    "q6_near_budget_exhaustion": "Campaigns near the end of their budget",
    "q7_ctr_by_device": "Click-through rate of each device",
}


def _named_campaigns(campaigns: DataFrame, advertisers: DataFrame, *extra: str) -> DataFrame:
    named = advertisers.select("advertiser_id", F.col("name").alias("advertiser"))
    return campaigns.select("campaign_id", "campaign_name", "advertiser_id", *extra).join(named, "advertiser_id")


def _window_sums(events: DataFrame, start: date, end: date, *more) -> DataFrame:
    """(campaign_id, impressions, clicks) inside the window, and any other sums."""
    return events.filter(in_window("timestamp", start, end)).groupBy("campaign_id").agg(
        m.rows().alias("impressions"), m.true_count("was_clicked").alias("clicks"), *more)


def campaign_sums(events: DataFrame, start: date, end: date) -> DataFrame:
    """Impressions, clicks and cost inside the window, and all spend, per campaign in one pass."""
    inside = in_window("timestamp", start, end)
    return events.groupBy("campaign_id").agg(
        F.count_if(inside).alias("impressions"), F.count_if(inside & F.col("was_clicked")).alias("clicks"),
        F.sum(F.when(inside, F.col("ad_cost"))).alias("cost"), m.money_sum("ad_cost").alias("total_spent"))


def group_sums(events: DataFrame, start: date, end: date) -> DataFrame:
    """Sums inside the window per location, per user and per device in one pass; `of` names the grouping."""
    keys = ("location_id", "user_id", "device_id")
    grouped = events.filter(in_window("timestamp", start, end)).groupingSets(
        [[F.col(k)] for k in keys], *[F.col(k) for k in keys])
    of = F.when(F.grouping("location_id") == 0, keys[0]).when(F.grouping("user_id") == 0, keys[1]).otherwise(keys[2])
    return grouped.agg(
        of.alias("of"), m.rows().alias("impressions"), m.true_count("was_clicked").alias("clicks"),
        m.money_sum(F.when(F.col("was_clicked"), F.col("ad_revenue"))).alias("revenue"))


def _best_rates(sums, campaigns, advertisers, min_impressions, n):
    report = sums.filter(F.col("impressions") >= min_impressions).join(
        _named_campaigns(campaigns, advertisers), "campaign_id").withColumn(
        "ctr_pct", m.ctr_pct("clicks", "impressions"))
    return top_n(report, [F.desc("ctr_pct"), "campaign_name", "campaign_id"], n).select(
        "campaign_name", "advertiser", "impressions", "clicks", "ctr_pct")


def q1_top_campaigns_by_ctr(
    events: DataFrame, campaigns: DataFrame, advertisers: DataFrame,
    start: date, end: date, min_impressions: int = 100, n: int = 5,
) -> DataFrame:
    """Top `n` campaigns by clicks per hundred impressions, leaving out those with few impressions."""
    return _best_rates(_window_sums(events, start, end), campaigns, advertisers, min_impressions, n)


def _most_spent(sums, campaigns, advertisers, n):
    per_advertiser = (
        sums.join(campaigns.select("campaign_id", "advertiser_id"), "campaign_id")
        .groupBy("advertiser_id")
        .agg(
            F.sum("impressions").alias("impressions"),
            F.sum("clicks").alias("total_clicks"),
            m.money_sum("cost").alias("total_spend"),
        )
    )
    report = per_advertiser.join(
        advertisers.select("advertiser_id", F.col("name").alias("advertiser")), "advertiser_id"
    ).withColumn("ctr_pct", m.ctr_pct("total_clicks", "impressions"))
    return top_n(report, [F.desc("total_spend"), "advertiser", "advertiser_id"], n).select(
        "advertiser", "impressions", "total_clicks", "total_spend", "ctr_pct")


def q2_advertiser_spending(
    events: DataFrame, campaigns: DataFrame, advertisers: DataFrame, start: date, end: date, n: int = 10,
) -> DataFrame:
    """Top `n` advertisers by spend with their clicks. Campaign totals are summed up per advertiser."""
    return _most_spent(_window_sums(events, start, end, F.sum("ad_cost").alias("cost")), campaigns, advertisers, n)


def _unit_costs(sums, campaigns, advertisers):
    report = sums.withColumn("total_cost", F.col("cost").cast(m.MONEY)).join(
        _named_campaigns(campaigns, advertisers), "campaign_id")
    return (
        report.withColumn("cpc", m.cost_per_click("total_cost", "clicks"))
        .withColumn("cpm", m.cost_per_mille("total_cost", "impressions"))
        .orderBy(F.asc_nulls_first("cpc"), "campaign_name", "campaign_id")
        .select("campaign_name", "advertiser", "impressions", "clicks", "total_cost", "cpc", "cpm")
    )


def q3_campaign_cpc_cpm(
    events: DataFrame, campaigns: DataFrame, advertisers: DataFrame, start: date, end: date,
) -> DataFrame:
    """Cost per click and per thousand impressions, cheapest click first; no clicks means a null cpc, on top."""
    return _unit_costs(_window_sums(events, start, end, F.sum("ad_cost").alias("cost")), campaigns, advertisers)


def _best_places(sums, locations, n):
    """`sums` has location_id, click_events, total_revenue."""
    report = sums.withColumnRenamed("location_id", "country_id").join(locations, "country_id").withColumnRenamed(
        "country_name", "location")
    return top_n(report, [F.desc("total_revenue"), "location", "country_id"], n).select(
        "location", "click_events", "total_revenue")


def q4_top_locations_by_revenue(
    events: DataFrame, locations: DataFrame, start: date, end: date, n: int = 10,
) -> DataFrame:
    """Top `n` locations by the revenue of clicked events."""
    sums = (
        events.filter(in_window("timestamp", start, end) & F.col("was_clicked"))
        .groupBy("location_id")
        .agg(m.rows().alias("click_events"), m.money_sum("ad_revenue").alias("total_revenue"))
    )
    return _best_places(sums, locations, n)


def _most_engaged(clicks, users, locations, n):
    """`clicks` has user_id, total_clicks."""
    known = clicks.join(users.select("user_id", "age", "gender", "country_id"), "user_id")
    best = top_n(known, [F.desc("total_clicks"), "user_id"], n)
    return (
        best.join(locations, "country_id", "left")
        .withColumnRenamed("country_name", "country")
        .orderBy(F.desc("total_clicks"), "user_id")
        .select("user_id", "age", "gender", "country", "total_clicks")
    )


def q5_top_engaged_users(
    events: DataFrame, users: DataFrame, locations: DataFrame, start: date, end: date, n: int = 10,
) -> DataFrame:
    """Top `n` users by clicks with age, gender and country; a user without a country is kept."""
    clicks = (
        events.filter(in_window("timestamp", start, end) & F.col("was_clicked"))
        .groupBy("user_id")
        .agg(m.rows().alias("total_clicks"))
    )
    return _most_engaged(clicks, users, locations, n)


def _near_budget(spent, campaigns, advertisers, threshold_pct):
    """`spent` has campaign_id, total_spent."""
    funded = _named_campaigns(campaigns, advertisers, "budget").filter(F.col("budget") > 0)
    return (
        funded.join(spent, "campaign_id", "left")
        .withColumn("pct_budget_spent", m.pct_of("total_spent", "budget"))
        .filter(F.col("pct_budget_spent") > threshold_pct)
        .orderBy(F.desc("pct_budget_spent"), "campaign_name", "campaign_id")
        .select("campaign_name", "advertiser", F.col("budget").alias("total_budget"), "total_spent",
                "pct_budget_spent")
    )


def q6_near_budget_exhaustion(
    events: DataFrame, campaigns: DataFrame, advertisers: DataFrame, threshold_pct: float = 80,
) -> DataFrame:
    """Campaigns whose rounded share of budget spent is above the threshold, over all time.

    A campaign without events has a null share and is not reported.
    """
    spent = events.groupBy("campaign_id").agg(m.money_sum("ad_cost").alias("total_spent"))
    return _near_budget(spent, campaigns, advertisers, threshold_pct)


def _device_rates(sums, devices):
    return (
        sums.join(devices, "device_id")
        .withColumn("ctr_pct", m.ctr_pct("clicks", "impressions"))
        .orderBy(F.desc("ctr_pct"), "device_name")
        .select("device_name", "impressions", "clicks", "ctr_pct")
    )


def q7_ctr_by_device(events: DataFrame, devices: DataFrame, start: date, end: date) -> DataFrame:
    sums = events.filter(in_window("timestamp", start, end)).groupBy("device_id").agg(
        m.rows().alias("impressions"), m.true_count("was_clicked").alias("clicks"))
    return _device_rates(sums, devices)


def campaign_report(
    events: DataFrame, campaigns: DataFrame, advertisers: DataFrame, users: DataFrame, locations: DataFrame,
    devices: DataFrame, start: date, end: date, min_impressions: int = 100, by_group: DataFrame | None = None,
) -> dict[str, tuple[str, DataFrame]]:
    """All seven reports as key -> (title, frame).

    The two sets of sums are computed here and stored by a checkpoint, and every report reads those. `by_group` may
    give the facts without their campaign for the second set, where that spares a join.
    """
    enable_checkpoints(events.sparkSession)
    sums = campaign_sums(events, start, end).checkpoint()
    groups = group_sums(events if by_group is None else by_group, start, end).checkpoint()
    active = sums.filter("impressions > 0")

    def of(key: str) -> DataFrame:
        return groups.filter(F.col("of") == key)

    clicked = F.col("clicks") > 0
    frames = {
        "q1_top_campaigns_by_ctr": _best_rates(active, campaigns, advertisers, min_impressions, 5),
        "q2_advertiser_spending": _most_spent(active, campaigns, advertisers, 10),
        "q3_campaign_cpc_cpm": _unit_costs(active, campaigns, advertisers),
        "q4_top_locations_by_revenue": _best_places(of("location_id").filter(clicked).select(
            "location_id", F.col("clicks").alias("click_events"), F.col("revenue").alias("total_revenue")), locations, 10),
        "q5_top_engaged_users": _most_engaged(
            of("user_id").filter(clicked).select("user_id", F.col("clicks").alias("total_clicks")), users, locations, 10),
        "q6_near_budget_exhaustion": _near_budget(
            sums.select("campaign_id", "total_spent"), campaigns, advertisers, 80),
        "q7_ctr_by_device": _device_rates(of("device_id").select("device_id", "impressions", "clicks"), devices),
    }
    return {key: (TITLES[key], frame) for key, frame in frames.items()}
