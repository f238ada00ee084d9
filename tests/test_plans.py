"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from tallyworks.catalogue.queries import QUERIES
from tallyworks.catalogue import queries as q
from tallyworks.plans import cleaning

SF_DIR = "/root/testdata/sf0.001"
NAMES = sorted(n for n in QUERIES if not n.startswith(("stream_", "replay_")))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_join_no_python_and_no_unbounded_single_task_window(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert word not in plan
    # A window without keys may only run over the per-partition offsets of a sorted frame.
    for line in plan.splitlines():
        if re.search(r"\bWindow \[", line) and "windowspecdefinition(_part" not in line:
            assert re.search(r"\], \[[^\]]+\], \[", line), line


def test_filter_and_columns_reach_the_scan(spark):
    plan = plan_of(q.q1_top_campaigns_by_ctr(spark, SF_DIR))
    scan = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    assert "GreaterThanOrEqual(l_shipdate" in scan and "LessThan(l_shipdate" in scan
    columns = re.search(r"ReadSchema: struct<([^>]*)", scan).group(1)
    assert {c.split(":")[0] for c in columns.split(",")} == {"l_partkey", "l_returnflag", "l_shipdate"}


@pytest.mark.parametrize("name", ["q4_top_locations_by_revenue", "campaign_performance_by_day", "customer_stats"])
def test_aggregates_are_partial_before_the_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    before_shuffle = plan.split("Exchange hashpartitioning", 1)[1]
    assert "partial_" in before_shuffle


@pytest.mark.parametrize("name", ["last_ads_per_user", "upsert_last_wins", "user_engagements", "wiki_page_creates"])
def test_rows_per_key_are_limited_before_the_shuffle(spark, name):
    assert "row_number(), 1, Partial" in (plan := plan_of(QUERIES[name](spark, SF_DIR))) \
        or re.search(r"row_number\(\), \d+, Partial", plan)


@pytest.mark.parametrize("name", ["q1_top_campaigns_by_ctr", "most_reviewed", "top_clickers_30d"])
def test_top_n_needs_no_global_sort(spark, name):
    assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, SF_DIR))


def test_month_range_reaches_the_rollup_scan(spark, tmp_path):
    from tallyworks.plans import review_rollups as rr
    from tallyworks.sinks.tables import write_clustered
    write_clustered(q.product_monthly_counts(spark, SF_DIR), str(tmp_path / "t"), ["year", "month"], ["product_id"])
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")  # the default cuts the filters off
    plan = plan_of(rr.most_reviewed(spark.read.parquet(str(tmp_path / "t")), "1998-03-15", "1998-05-01"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    assert "year" in filters and "month" in filters


def test_review_inputs_are_evaluated_once(spark):
    """A computed rating is pasted neither into each parser nor into the filters on what they give."""
    computed = [F.concat_ws("", F.lit("mark"), F.col("id").cast("string")).alias(c) for c in (
        "review_id", "product_id", "customer_id", "marketplace", "product_title", "product_category", "review_headline",
        "review_body", "helpful_votes", "total_votes", "vine", "verified_purchase")]
    raw = spark.range(10).select(*computed, F.substring(F.hash("id").cast("string"), 1, 1).alias("star_rating"),
                                 F.date_format(F.lit("2024-01-01").cast("date"), "yyyy-MM-dd").alias("review_date"))
    plan = cleaning.clean_reviews(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("hash(id") <= 2  # where it is made, and in the null check before
