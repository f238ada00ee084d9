"""Sources, sinks and the end-to-end loads."""

import csv
import os
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import types as T
from pyspark.sql import functions as F

from tallyworks import schemas, session
from tallyworks.plans import event_rollups as er, jobs
from tallyworks.sinks import tables, topics
from tallyworks.sources import files, intake, jdbc


def write_csv(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f)
        writer.writerow(header)
        writer.writerows(rows)
    return str(path)


EVENT_HEADER = ["EventID", "AdvertiserName", "CampaignName", "CampaignTargetingCountry", "UserID", "Location",
                "Device", "AdSlotSize", "Timestamp", "AdCost", "WasClicked", "ClickTimestamp", "AdRevenue", "Extra"]


def event(i, user="1", day="2024-10-01", cost="1.00", clicked="True", campaign="C1"):
    return [f"{i:032x}", "Adv, \"Inc\"", campaign, "USA", user, "UK", "Mobile", "300x250", f"{day} 10:00:00", cost,
            clicked, "", "2.00", "ignored"]


@pytest.fixture
def events_csv(tmp_path):
    rows = [event(1), event(2, day="2024-10-02", clicked="False"), event(3, user="2", cost="bad"),
            event(3, user="2", cost="bad"), event(4, day="never"), event(5, user="")]
    return write_csv(tmp_path / "ad_events.csv", EVENT_HEADER, rows)


def test_csv_is_matched_by_header(spark, events_csv):
    raw = files.read_ad_events(spark, events_csv)
    assert raw.columns == schemas.AD_EVENTS_RAW.fieldNames()
    row = raw.first()
    assert row["AdvertiserName"] == 'Adv, "Inc"' and row["BidAmount"] is None and row["AdRevenue"] == "2.00"


def test_event_load_end_to_end(spark, events_csv, tmp_path):
    out = str(tmp_path / "out")
    counts = jobs.load_event_tables(spark, events_csv, out)
    assert counts == {"raw": 6, "rows": 6, "failed": 1}
    days = files.read_table(spark, f"{out}/campaign_performance_by_day").collect()
    assert {(r["event_date"], r["total_impressions"], r["total_clicks"], r["total_ad_cost"]) for r in days} == {
        (date(2024, 10, 1), 4, 4, D("2.00")), (date(2024, 10, 2), 1, 0, D("1.00"))}
    history = files.read_table(spark, f"{out}/user_engagement_history")
    assert history.count() == 3  # the repeated event collapsed; undated and userless rows have no key
    ranked = files.read_table(spark, f"{out}/most_active_users").orderBy("rank").collect()
    assert [(r["user_id"], r["total_interactions"]) for r in ranked] == [(1, 5), (2, 4)]
    usa = files.read_keyed(spark, f"{out}/high_spending_advertisers_by_region", region="USA").collect()
    assert [(r["advertiser_name"], r["total_spend"], r["rank"]) for r in usa] == [('Adv, "Inc"', D("4.00"), 1)]
    jobs.load_event_tables(spark, events_csv, out)  # a rerun replaces, nothing stale stays
    assert files.read_table(spark, f"{out}/most_active_users").count() == 2


def test_review_load_and_partition_pruning(spark, tmp_path):
    header = schemas.REVIEWS_RAW.fieldNames()
    base = dict(marketplace="US", customer_id="u1", review_id="r", product_id="p", product_title="T",
                product_category="c", star_rating="5", helpful_votes="0", total_votes="0", vine="0",
                verified_purchase="1", review_headline="h", review_body="b", review_date="2015-01-05")
    rows = [{**base, "review_id": f"r{i}", "review_date": f"2015-0{1 + i % 3}-05"} for i in range(9)]
    path = write_csv(tmp_path / "reviews.csv", header, [[r[c] for c in header] for r in rows])
    out = str(tmp_path / "out")
    assert jobs.load_review_tables(spark, path, out) == {"raw": 9, "rows": 9, "failed": 0}
    month = files.read_keyed(spark, f"{out}/product_monthly_counts", year=2015, month=2)
    assert [r["review_count"] for r in month.collect()] == [3]
    plan = month._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in pruned and "month" in pruned
    assert len(files.read_keyed(spark, f"{out}/reviews_by_product", product_id="p").collect()) == 9


def test_model_load(spark, events_csv, tmp_path):
    campaigns = write_csv(tmp_path / "campaigns.csv",
                          ["CampaignID", "AdvertiserName", "CampaignName", "CampaignStartDate", "CampaignEndDate",
                           "TargetingCriteria", "AdSlotSize", "Budget"],
                          [["7", "Adv, \"Inc\"", "C1", "2024-10-01", "2024-10-31", "USA", "300x250", "10"],
                           ["8", "Other", "C2", "2024-10-01", "", "UK", "odd", "5"]])
    users = write_csv(tmp_path / "users.csv", ["UserID", "Age", "Gender", "Location", "Interests", "SignupDate"],
                      [["1", "30", "F", "USA", "a, b", "2020-01-01"], ["2", "31", "M", "UK", "b", ""]])
    out = str(tmp_path / "model")
    names = jobs.load_model(spark, events_csv, campaigns, users, out)
    read = {n: files.read_table(spark, f"{out}/{n}") for n in names}
    assert {n: df.count() for n, df in read.items()} == {
        "locations": 2, "advertisers": 2, "interests": 2, "devices": 1, "ad_slot_sizes": 1, "campaigns": 2,
        "users": 2, "user_interests": 3, "ad_events": 4}
    slots = {r["campaign_id"]: r["slot_id"] for r in read["campaigns"].collect()}
    assert slots == {7: 1, 8: None}
    assert {r["campaign_id"] for r in read["ad_events"].collect()} == {7}


def test_clustered_layout_sorts_and_splits_a_hot_folder(spark, tmp_path):
    df = spark.range(4000).select(F.lit(2020).alias("year"), (F.col("id") % 97).alias("n"), "id")
    path = str(tmp_path / "t")
    tables.write_clustered(df, path, ["year"], [F.desc("n"), "id"], partitions=4)
    parts = sorted(f for f in os.listdir(f"{path}/year=2020") if f.endswith(".parquet"))
    assert len(parts) == 4
    for name in parts:
        rows = [(-r["n"], r["id"]) for r in spark.read.parquet(f"{path}/year=2020/{name}").collect()]
        assert rows == sorted(rows)


def test_refresh_replaces_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "daily")
    schema = "day int, k string, n int"
    tables.refresh_partitions(spark.createDataFrame([(1, "a", 1), (2, "a", 1), (2, "b", 5)], schema), path, ["day"], ["k"])
    for _ in range(2):
        tables.refresh_partitions(spark.createDataFrame([(2, "a", 9)], schema), path, ["day"], ["k"])
        assert sorted((r["day"], r["k"], r["n"]) for r in spark.read.parquet(path).collect()) == [(1, "a", 1), (2, "a", 9)]


def test_counted_reports_rows_and_failures(spark, tmp_path):
    df, seen = tables.counted(spark.range(10), F.col("id") > 6, "m")
    tables.replace_table(df, str(tmp_path / "t"))
    assert seen.get == {"rows": 10, "failed": 3}


def test_publish_omits_null_fields(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    topics.publish(df, str(tmp_path / "topic"))
    topics.publish(df.filter("a = 2"), str(tmp_path / "topic"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "topic")).collect()) == [
        '{"a":1}', '{"a":2,"b":"x"}', '{"a":2,"b":"x"}']


def test_intake_skips_blank_and_keeps_bad_apart(spark):
    texts = ["", "  ", None, '{"meta":', '{"page_title":"T"}', '{"meta":{"domain":"d"},"performer":{"user_id":"7"}}', "nonsense"]
    messages = spark.createDataFrame([(t,) for t in texts], "value string")
    good, bad = intake.parse_events(messages, schemas.PAGE_CREATE)
    assert sorted(r["value"] for r in bad.collect()) == ["nonsense", '{"meta":']
    parsed = good.select("e.meta.domain", "e.page_title", "e.performer.user_id").collect()
    assert sorted(map(tuple, parsed), key=str) == [("d", None, None), (None, "T", None)]
    counts = {(r["state"], r["domain"]): r["messages"] for r in intake.intake_counts(messages, schemas.PAGE_CREATE).collect()}
    assert counts == {("blank", "unknown"): 3, ("malformed", "unknown"): 2, ("good", "unknown"): 1, ("good", "d"): 1}


class RecordingReader:
    """Stands in for `spark.read`: there is no database here, so only the options are checked."""

    def __init__(self):
        self.seen = {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def options(self, **more):
        self.seen.update(more)
        return self

    def load(self):
        return self.seen


def test_jdbc_read_is_split_by_key():
    class Session:
        read = RecordingReader()

    seen = jdbc.read_jdbc(Session(), "jdbc:x", "ad_events", "user_id", (0, 700_000), partitions=32, user="u")
    assert seen["partitionColumn"] == "user_id" and seen["upperBound"] == "700000" and seen["numPartitions"] == "32"
    assert seen["dbtable"] == "ad_events" and seen["user"] == "u"


def test_shared_folder_is_the_one_set_or_in_the_warehouse(spark):
    class Session:
        def __init__(self, **conf):
            self.conf = conf

    assert session.shared_dir(Session(**{"spark.checkpoint.dir": "/shared/c"})) == "/shared/c"
    assert session.shared_dir(Session(**{"spark.sql.warehouse.dir": "hdfs:/w/"})) == "hdfs:/w/tallyworks-shared"


def test_a_touched_partition_without_rows_is_removed(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "day int, n int"
    tables.refresh_partitions(spark.createDataFrame([(1, 1), (2, 2), (3, 3)], schema), path, ["day"])
    touched = spark.createDataFrame([(2,), (3,)], "day int")
    tables.refresh_partitions(spark.createDataFrame([(3, 30)], schema), path, ["day"], touched=touched)
    assert sorted((r["day"], r["n"]) for r in spark.read.parquet(path).collect()) == [(1, 1), (3, 30)]


def test_cluster_sizes_grow_with_the_input():
    mib = 1 << 20
    small, large = session.cluster_conf(10 * 1024 * mib, 8), session.cluster_conf(100 * mib * mib, 8000)
    assert small == {"spark.sql.files.maxPartitionBytes": str(128 * mib), "spark.sql.shuffle.partitions": "20"}
    assert int(large["spark.sql.files.maxPartitionBytes"]) > 500 * mib
    assert int(large["spark.sql.shuffle.partitions"]) == 100 * mib * mib // (512 * mib)


def test_files_with_another_column_order_are_refused(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.csv").write_text("review_id,product_id\nr1,p1\n")
    (folder / "b.csv").write_text("product_id,review_id\np2,r2\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(folder), T.StructType.fromDDL("review_id string, product_id string")).collect()


def test_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "breaks.csv"
    path.write_text('review_id,body\nr1,"two\nlines"\n')
    schema = T.StructType.fromDDL("review_id string, body string, absent int")
    assert [tuple(r) for r in files.read_csv(spark, str(path), schema, multi_line=True).collect()] == [
        ("r1", "two\nlines", None)]


def test_keyed_read_of_a_null_key(spark, tmp_path):
    path = str(tmp_path / "keyed")
    df = spark.createDataFrame([("a", 1), (None, 2)], "region string, n int")
    df.write.partitionBy("region").parquet(path)
    assert [r["n"] for r in files.read_keyed(spark, path, region=None).collect()] == [2]


def test_last_ads_of_one_user(spark, events_csv):
    from tallyworks.plans.cleaning import clean_events
    history = er.user_engagement_history(clean_events(files.read_ad_events(spark, events_csv)))
    newest = er.last_ads_per_user(history, user_id=1, n=1).collect()
    assert [(r["event_timestamp"].day, r["was_clicked"]) for r in newest] == [(2, False)]
