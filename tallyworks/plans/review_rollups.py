"""Rollups of cleaned reviews, and the queries over them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tallyworks.functions import measures as m
from tallyworks.functions.calendar import in_months, month_label
from tallyworks.functions.serialise import title_prefix
from tallyworks.operators.keyed import one_per_key, one_per_key_sorted
from tallyworks.operators.ranking import top_n

PRODUCT_COLUMNS = (
    "product_id", "star_rating", "review_date", "review_id", "customer_id", "marketplace",
    "product_title", "product_category", "helpful_votes", "total_votes", "vine", "verified_purchase",
    "review_headline", "review_body",
)
CUSTOMER_COLUMNS = (
    "customer_id", "review_date", "review_id", "product_id", "product_title", "star_rating",
    "verified_purchase", "marketplace", "review_headline", "review_body",
)
PRODUCT_KEY = ("product_id", "star_rating", "review_date", "review_id")
CUSTOMER_KEY = ("customer_id", "review_date", "review_id")


def verified() -> Column:
    return F.col("verified_purchase") == 1


def low_rated() -> Column:
    return F.col("star_rating").isin(1, 2)


def high_rated() -> Column:
    return F.col("star_rating").isin(4, 5)


def _by_month(reviews: DataFrame) -> DataFrame:
    return reviews.withColumn("year", F.year("review_date")).withColumn("month", F.month("review_date"))


def _reviews() -> Column:
    return F.count("review_id").alias("review_count")


# Rollups

def product_stats(reviews: DataFrame) -> DataFrame:
    """Reviews and average rating of every product and title."""
    return (
        reviews.groupBy("product_id", "product_title")
        .agg(
            F.count("review_id").alias("total_reviews"),
            F.sum("star_rating").alias("_stars"),
            F.count("star_rating").alias("_rated"),
        )
        .select("product_id", "product_title", "total_reviews",
                m.mean_rating("_stars", "_rated").alias("avg_star_rating"))
    )


def customer_stats(reviews: DataFrame) -> DataFrame:
    """Verified reviews per customer; reviews without a customer form one group."""
    return reviews.groupBy("customer_id").agg(F.count("review_id").alias("total_verified_reviews"))


def monthly_product_reviews(reviews: DataFrame) -> DataFrame:
    """Reviews of every product and month, in that order."""
    return (
        _by_month(reviews).groupBy("product_id", "year", "month").agg(_reviews())
        .orderBy("product_id", "year", "month")
    )


def product_keyed(reviews: DataFrame) -> DataFrame:
    """The columns kept per product, one row per review of it; copies collapse before they are shuffled."""
    return one_per_key(reviews.select(*PRODUCT_COLUMNS), PRODUCT_KEY)


def customer_keyed(reviews: DataFrame) -> DataFrame:
    return one_per_key(reviews.select(*CUSTOMER_COLUMNS), CUSTOMER_KEY)


def reviews_by_product(
    reviews: DataFrame, product_id: str | None = None, star_rating: int | None = None
) -> DataFrame:
    """Reviews keyed by product: rating ascending, newest first, then id. Both filters are optional."""
    if star_rating is not None:
        if not 1 <= star_rating <= 5:
            raise ValueError("star_rating must be between 1 and 5")
        reviews = reviews.filter(F.col("star_rating") == star_rating)
    if product_id is not None:
        reviews = reviews.filter(F.col("product_id") == product_id)
    return one_per_key_sorted(reviews.select(*PRODUCT_COLUMNS), PRODUCT_KEY, ["review_date"])


def reviews_by_customer(reviews: DataFrame, customer_id: str | None = None) -> DataFrame:
    """Reviews keyed by customer, newest first, then id."""
    if customer_id is not None:
        reviews = reviews.filter(F.col("customer_id") == customer_id)
    return one_per_key_sorted(reviews.select(*CUSTOMER_COLUMNS), CUSTOMER_KEY, ["review_date"])


def product_monthly_counts(reviews: DataFrame) -> DataFrame:
    """Reviews of every month, product and title. Two titles of one product are two rows."""
    return _by_month(reviews).groupBy("year", "month", "product_id", "product_title").agg(_reviews())


def customer_monthly(reviews: DataFrame, predicate: Column) -> DataFrame:
    """Reviews that meet `predicate` per month and customer: `verified()`, `low_rated()` or `high_rated()`."""
    return _by_month(reviews.filter(predicate)).groupBy("year", "month", "customer_id").agg(_reviews())


# Queries over the rollups

def top_products_by_reviews(stats: DataFrame, n: int = 10) -> DataFrame:
    best = top_n(stats, [F.desc("total_reviews"), "product_id", "product_title"], n)
    return best.select("product_id", "total_reviews", "avg_star_rating", "product_title",
                       title_prefix("product_title").alias("short_title"))


def highly_rated_products(
    stats: DataFrame, min_rating: float = 4.5, min_reviews: int = 20, n: int = 10
) -> DataFrame:
    good = stats.filter((F.col("avg_star_rating") >= min_rating) & (F.col("total_reviews") >= min_reviews))
    return top_n(good, [F.desc("avg_star_rating"), F.desc("total_reviews"), "product_id", "product_title"], n)


def top_reviewers(stats: DataFrame, n: int = 10) -> DataFrame:
    return top_n(stats, [F.desc("total_verified_reviews"), "customer_id"], n)


def heavy_reviewer_count(stats: DataFrame, more_than: int = 50) -> DataFrame:
    return stats.agg(F.count_if(F.col("total_verified_reviews") > more_than).alias("customers"))


def top_product_trend(stats: DataFrame, monthly: DataFrame) -> DataFrame:
    """Monthly counts of the single most-reviewed product."""
    best = top_n(stats, [F.desc("total_reviews"), "product_id", "product_title"], 1).select("product_id")
    trend = monthly.join(best, "product_id", "left_semi")
    return trend.orderBy("year", "month").select(
        "product_id", month_label("year", "month").alias("year_month"), "review_count"
    )


def monthly_volume(monthly: DataFrame) -> DataFrame:
    """Reviews per month over all products, re-aggregated from the product rollup."""
    return (
        monthly.groupBy("year", "month").agg(F.sum("review_count").alias("total_reviews"))
        .orderBy("year", "month")
        .select(month_label("year", "month").alias("year_month"), "total_reviews")
    )


def _check_n(n: int) -> None:
    if not 1 <= n <= 500:
        raise ValueError("n must be between 1 and 500")


def most_reviewed(monthly: DataFrame, start: str | date, end: str | date, n: int = 10) -> DataFrame:
    """Top `n` products over the months touched by the range.

    A product with several titles shows the one of its latest month, of that month the one with the
    fewest reviews, of those the greatest.
    """
    _check_n(n)
    latest = F.struct("year", "month", -F.col("review_count"), "product_title")
    totals = (
        monthly.filter(in_months(start, end))
        .groupBy("product_id")
        .agg(
            F.max_by("product_title", latest).alias("product_title"),
            F.sum("review_count").alias("review_count"),
        )
    )
    return top_n(totals, [F.desc("review_count"), "product_id"], n)


def _most_productive(monthly: DataFrame, start, end, n: int, metric: str) -> DataFrame:
    _check_n(n)
    totals = (
        monthly.filter(in_months(start, end))
        .groupBy("customer_id").agg(F.sum("review_count").alias(metric))
    )
    return top_n(totals, [F.desc(metric), "customer_id"], n)


def most_productive_customers(monthly: DataFrame, start, end, n: int = 10) -> DataFrame:
    """Top `n` customers by verified reviews."""
    return _most_productive(monthly, start, end, n, "verified_review_count")


def most_productive_haters(monthly: DataFrame, start, end, n: int = 10) -> DataFrame:
    """Top `n` customers by one- and two-star reviews."""
    return _most_productive(monthly, start, end, n, "low_star_review_count")


def most_productive_backers(monthly: DataFrame, start, end, n: int = 10) -> DataFrame:
    """Top `n` customers by four- and five-star reviews."""
    return _most_productive(monthly, start, end, n, "high_star_review_count")
