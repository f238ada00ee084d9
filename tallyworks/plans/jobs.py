"""End-to-end loads: raw files to stored, clustered tables.

The cleaned rows are stored once; every rollup reads only its columns back from there. Nothing is cached
and nothing is collected, so a lost executor costs a recomputation of its tasks and no more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyworks.plans import cleaning, event_rollups as er, normalise, review_rollups as rr
from tallyworks.sinks.tables import counted, replace_table, write_clustered
from tallyworks.sources import files


def store_clean(
    raw: DataFrame, clean: Callable[[DataFrame], DataFrame], path: str, bad: Column | None = None
) -> dict:
    """Store the cleaned rows of `raw` and count rows before and after on the way, without another job."""
    before, seen_raw = counted(raw, name=f"raw of {path}")
    after, seen_clean = counted(clean(before), bad, f"clean of {path}")
    replace_table(after, path)
    return {"raw": seen_raw.get["rows"], **seen_clean.get}


def load_event_tables(spark: SparkSession, events_csv: str, out: str) -> dict:
    """Events and their five query tables. Returns the number of rows read, stored and undated ("failed")."""
    path = f"{out}/ad_events"
    raw = files.read_ad_events(spark, events_csv)
    counts = store_clean(raw, cleaning.clean_events, path, F.col("event_timestamp").isNull())
    events = files.read_table(spark, path)
    newest = F.desc("event_date")
    write_clustered(er.campaign_performance_by_day(events), f"{out}/campaign_performance_by_day",
                    sort_cols=["campaign_name", newest])
    write_clustered(er.advertiser_spend_by_day(events), f"{out}/advertiser_spend_by_day",
                    sort_cols=["advertiser_name", newest])
    write_clustered(er.user_engagement_history(events), f"{out}/user_engagement_history",
                    sort_cols=["user_id", F.desc("event_timestamp"), "event_id"])
    write_clustered(er.most_active_users(events), f"{out}/most_active_users",
                    part_cols=["activity_bucket"], sort_cols=["rank"])
    write_clustered(er.high_spending_advertisers_by_region(events), f"{out}/high_spending_advertisers_by_region",
                    part_cols=["region"], sort_cols=["rank"])
    return counts


def load_review_tables(spark: SparkSession, reviews_csv: str, out: str) -> dict:
    """Reviews and their keyed, monthly and statistics tables. Returns the number of rows read and stored."""
    replace_table(files.read_reviews(spark, reviews_csv), f"{out}/_raw_reviews")  # parsed once, read twice
    raw = files.read_table(spark, f"{out}/_raw_reviews")
    counts = store_clean(raw, cleaning.clean_reviews, f"{out}/reviews")
    replace_table(cleaning.clean_verified_reviews(raw), f"{out}/verified_reviews")
    reviews = files.read_table(spark, f"{out}/reviews")
    bought = files.read_table(spark, f"{out}/verified_reviews")

    write_clustered(rr.product_keyed(reviews), f"{out}/reviews_by_product",
                    sort_cols=["product_id", "star_rating", F.desc("review_date"), "review_id"])
    write_clustered(rr.customer_keyed(reviews), f"{out}/reviews_by_customer",
                    sort_cols=["customer_id", F.desc("review_date"), "review_id"])
    most = F.desc("review_count")
    write_clustered(rr.product_monthly_counts(reviews), f"{out}/product_monthly_counts",
                    part_cols=["year", "month"], sort_cols=[most, "product_id", "product_title"])
    for name, predicate in (("verified", rr.verified()), ("hater", rr.low_rated()), ("backer", rr.high_rated())):
        write_clustered(rr.customer_monthly(reviews, predicate), f"{out}/customer_{name}_monthly",
                        part_cols=["year", "month"], sort_cols=[most, "customer_id"])
    write_clustered(rr.product_stats(bought), f"{out}/product_stats", sort_cols=["product_id", "product_title"])
    write_clustered(rr.customer_stats(bought), f"{out}/customer_stats", sort_cols=["customer_id"])
    write_clustered(rr.monthly_product_reviews(bought), f"{out}/monthly_product_reviews",
                    sort_cols=["product_id", "year", "month"])
    return counts


def load_model(spark: SparkSession, events_csv: str, campaigns_csv: str, users_csv: str, out: str) -> list[str]:
    """The normalised model; returns the names of the stored tables."""
    events = cleaning.clean_events(files.read_ad_events(spark, events_csv))
    replace_table(events, f"{out}/_clean_events")
    tables = normalise.normalise_model(
        files.read_table(spark, f"{out}/_clean_events"),
        cleaning.clean_campaigns(files.read_campaigns(spark, campaigns_csv)),
        cleaning.clean_users(files.read_users(spark, users_csv)),
    )
    for name, df in tables.items():
        replace_table(df, f"{out}/{name}")
    return list(tables)
