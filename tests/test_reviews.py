"""Review rollups and the month-range queries."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyworks.plans import review_rollups as rr


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def reviews(spark):
    data = [
        ("r1", "p1", "T", "u1", 5, 1, date(2015, 1, 1)), ("r2", "p1", "T", "u2", 4, 1, date(2015, 1, 31)),
        ("r3", "p1", "T2", "u1", 1, 0, date(2015, 2, 1)), ("r4", "p2", "S", "u1", 2, 1, date(2014, 12, 31)),
        ("r5", "p2", "S", None, 3, 1, date(2015, 2, 28)), ("r6", "p3", "Z", "u3", 4, 1, date(2015, 3, 1)),
    ]
    df = spark.createDataFrame(
        data, "review_id string, product_id string, product_title string, customer_id string, star_rating int, "
              "verified_purchase int, review_date date")
    extra = {c: F.lit(None).cast("string") for c in ("marketplace", "product_category", "review_headline", "review_body")}
    votes = {c: F.lit(0) for c in ("helpful_votes", "total_votes", "vine")}
    return df.withColumns({**extra, **votes})


def test_stats_group_by_title_too(reviews):
    assert sorted(rows(rr.product_stats(reviews))) == [
        ("p1", "T", 2, 4.5), ("p1", "T2", 1, 1.0), ("p2", "S", 2, 2.5), ("p3", "Z", 1, 4.0)]


def test_unrated_reviews_count_but_do_not_weigh(spark):
    df = spark.createDataFrame([("a", "p", "t", 5), ("b", "p", "t", None)],
                               "review_id string, product_id string, product_title string, star_rating int")
    assert rows(rr.product_stats(df)) == [("p", "t", 2, 5.0)]


def test_customer_stats_keep_the_nameless_group(reviews):
    assert dict(rows(rr.customer_stats(reviews))) == {"u1": 3, "u2": 1, None: 1, "u3": 1}


def test_month_range_takes_whole_months(reviews):
    monthly = rr.product_monthly_counts(reviews)
    got = rows(rr.most_reviewed(monthly, "2015-01-15", "2015-02-01"))
    assert got == [("p1", "T2", 3), ("p2", "S", 1)]
    over_year_end = rows(rr.most_reviewed(monthly, "2014-12-31", "2015-01-01"))
    assert over_year_end == [("p1", "T", 2), ("p2", "S", 1)]


def test_two_titles_with_the_same_count_are_both_kept(spark, reviews):
    twins = reviews.filter("review_id = 'r3'").unionByName(
        reviews.filter("review_id = 'r3'").withColumn("product_title", F.lit("T9")))
    assert rr.product_monthly_counts(twins).count() == 2
    assert rows(rr.most_reviewed(rr.product_monthly_counts(twins), "2015-02-01", "2015-02-02")) == [("p1", "T9", 2)]


def test_haters_and_backers(reviews):
    low = rr.customer_monthly(reviews, rr.low_rated())
    high = rr.customer_monthly(reviews, rr.high_rated())
    assert rows(rr.most_productive_haters(low, "2014-01-01", "2015-12-31")) == [("u1", 2)]
    assert rows(rr.most_productive_backers(high, "2014-01-01", "2015-12-31", n=2)) == [("u1", 1), ("u2", 1)]
    bought = rr.customer_monthly(reviews.dropna(subset=["customer_id"]), rr.verified())
    assert rr.most_productive_customers(bought, "2015-01-01", "2015-01-01").columns == [
        "customer_id", "verified_review_count"]


@pytest.mark.parametrize("n", [0, 501])
def test_n_is_bounded(reviews, n):
    with pytest.raises(ValueError):
        rr.most_reviewed(rr.product_monthly_counts(reviews), "2015-01-01", "2015-01-02", n)


def test_reviews_by_product_order_and_filters(reviews):
    got = [r["review_id"] for r in rr.reviews_by_product(reviews, "p1").collect()]
    assert got == ["r3", "r2", "r1"]
    assert [r["review_id"] for r in rr.reviews_by_product(reviews, "p1", 4).collect()] == ["r2"]
    with pytest.raises(ValueError):
        rr.reviews_by_product(reviews, "p1", 6)


def test_reviews_by_customer_newest_first(reviews):
    assert [r["review_id"] for r in rr.reviews_by_customer(reviews, "u1").collect()] == ["r3", "r1", "r4"]


def test_copies_of_a_review_are_one_row_of_the_keyed_tables_but_are_counted(reviews):
    doubled = reviews.unionByName(reviews)
    assert rows(rr.reviews_by_product(doubled)) == rows(rr.reviews_by_product(reviews))
    assert rr.reviews_by_customer(doubled, "u1").count() == 3
    assert dict(rows(rr.customer_stats(doubled)))["u1"] == 6


@pytest.fixture(scope="module")
def odd_reviews(spark):
    """Copies, rows of one key that differ, nulls in the keys, and dates before 1970 and far ahead."""
    rng = random.Random(11)
    dates = [None, date(1, 1, 1), date(1969, 12, 31), date(1970, 1, 1), date(1970, 1, 2), date(2015, 3, 1), date(9999, 12, 31)]
    kinds = {"star_rating": "int", "helpful_votes": "int", "total_votes": "int", "vine": "int", "verified_purchase": "int",
             "review_date": "date"}
    values = {"star_rating": [None, 1, 5], "review_date": dates, "helpful_votes": [None, 0, 1], "total_votes": [3], "vine": [0, 1],
              "verified_purchase": [0, 1]}
    some = {c: values.get(c, [None, "a", "b"]) for c in rr.PRODUCT_COLUMNS}
    data = [tuple(rng.choice(some[c]) for c in rr.PRODUCT_COLUMNS) for _ in range(1_500)]
    return spark.createDataFrame(data + data[:200], ", ".join(f"{c} {kinds.get(c, 'string')}" for c in rr.PRODUCT_COLUMNS)).repartition(7)


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz"])
def test_keyed_reviews_equal_dropping_copies_and_then_sorting(odd_reviews, kind):
    df = odd_reviews
    if kind != "date":  # times of one day are different keys
        df = df.withColumn("review_date", F.col("review_date").cast(kind) + F.make_dt_interval(hours="vine", mins="total_votes"))
    newest = F.desc("review_date")
    by_product, by_customer = rr.reviews_by_product(df), rr.reviews_by_customer(df)
    assert by_product.dtypes == df.dtypes and by_customer.columns == list(rr.CUSTOMER_COLUMNS)
    assert rows(by_product) == rows(rr.product_keyed(df).orderBy("product_id", "star_rating", newest, "review_id"))
    assert rows(by_customer) == rows(rr.customer_keyed(df).orderBy("customer_id", newest, "review_id"))
    assert 100 < by_product.count() < 1_500


def test_wide_reviews_are_shuffled_and_sorted_once(odd_reviews):
    one_read = odd_reviews.sparkSession.createDataFrame(odd_reviews.collect(), odd_reviews.schema)
    for df in (rr.reviews_by_product(one_read), rr.reviews_by_customer(one_read)):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
        assert plan.count("Exchange ") == plan.count("Exchange rangepartitioning") == plan.count("Sort [") == 1


def test_top_product_trend_and_volume(reviews):
    monthly, stats = rr.monthly_product_reviews(reviews), rr.product_stats(reviews)
    assert rows(rr.top_product_trend(stats, monthly)) == [("p1", "2015-01", 2), ("p1", "2015-02", 1)]
    assert rows(rr.monthly_volume(monthly)) == [("2014-12", 1), ("2015-01", 2), ("2015-02", 2), ("2015-03", 1)]


def test_queries_over_stats(spark):
    stats = spark.createDataFrame(
        [("p1", "x" * 60, 25, 4.5), ("p2", "b", 19, 5.0), ("p3", "c", 30, 4.49), ("p4", "d", 25, 4.9)],
        "product_id string, product_title string, total_reviews long, avg_star_rating double")
    assert [r["product_id"] for r in rr.highly_rated_products(stats).collect()] == ["p4", "p1"]
    best = rr.top_products_by_reviews(stats, 2).collect()
    assert [(r["product_id"], len(r["product_title"]), len(r["short_title"])) for r in best] == [
        ("p3", 1, 1), ("p1", 60, 50)]
    customers = spark.createDataFrame([("u", 50), ("v", 51)], "customer_id string, total_verified_reviews long")
    assert rr.heavy_reviewer_count(customers).first()[0] == 1


def test_rollup_of_rollup_equals_direct_count(reviews):
    direct = reviews.groupBy("product_id").agg(F.count("review_id").alias("n"))
    again = rr.monthly_product_reviews(reviews).groupBy("product_id").agg(F.sum("review_count").alias("n"))
    assert sorted(rows(direct)) == sorted(rows(again))
