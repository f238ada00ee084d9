"""Campaign report, rollups and lookups on small frames with known answers."""

import json
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallyworks.plans import comparison, event_rollups as er, lookups, normalise, reports
from tallyworks.sinks.reports import run_report

START, END = date(2024, 10, 1), date(2024, 10, 31)


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def model(spark):
    facts = [
        # id, campaign, user, place, device, time, cost, clicked, revenue
        ("e1", 1, 100, 1, 1, datetime(2024, 10, 1, 0, 0), "1.00", True, "5.00"),
        ("e2", 1, 100, 1, 1, datetime(2024, 10, 31, 23, 59, 59), "2.00", False, "0.00"),
        ("e3", 1, 101, 2, 2, datetime(2024, 11, 1, 0, 0), "4.00", True, "7.00"),
        ("e4", 2, 102, 2, 2, datetime(2024, 10, 5), "8.00", False, "0.00"),
        ("e5", 2, None, None, None, datetime(2024, 10, 6), "0.05", False, "0.00"),
        ("e6", 3, 101, 1, 1, datetime(2024, 10, 7), "3.00", True, "5.00"),
        ("e7", 3, 999, 1, 9, datetime(2024, 10, 8), "3.00", True, "1.00"),
    ]
    events = spark.createDataFrame(
        [f + (None,) for f in facts],
        "event_id string, campaign_id int, user_id int, location_id int, device_id int, timestamp timestamp_ntz, "
        "ad_cost string, was_clicked boolean, ad_revenue string, click_timestamp timestamp_ntz",
    ).withColumns({c: F.col(c).cast("decimal(12,2)") for c in ("ad_cost", "ad_revenue")})
    campaigns = spark.createDataFrame(
        [(1, 1, "c1", D("8.75")), (2, 1, "c2", D("10.06")), (3, 2, "c3", D("0.00")), (4, 2, "idle", D("50.00"))],
        "campaign_id int, advertiser_id int, campaign_name string, budget decimal(14,2)")
    advertisers = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "advertiser_id int, name string")
    users = spark.createDataFrame(
        [(100, 20, "F", 1), (101, 30, "M", None), (102, 40, "F", 2), (103, 50, "M", 2)],
        "user_id int, age int, gender string, country_id int")
    places = spark.createDataFrame([(1, "USA"), (2, "UK")], "country_id int, country_name string")
    devices = spark.createDataFrame([(1, "Mobile"), (2, "Desktop")], "device_id int, device_name string")
    return dict(events=events, campaigns=campaigns, advertisers=advertisers, users=users, locations=places,
                devices=devices)


def pick(model, *names):
    return [model[n] for n in names]


def test_q1_bounds_and_minimum(model):
    got = rows(reports.q1_top_campaigns_by_ctr(*pick(model, "events", "campaigns", "advertisers"), START, END, 2))
    assert got == [("c3", "B", 2, 2, 100.0), ("c1", "A", 2, 1, 50.0), ("c2", "A", 2, 0, 0.0)]
    assert rows(reports.q1_top_campaigns_by_ctr(*pick(model, "events", "campaigns", "advertisers"), START, END, 3)) == []


def test_q2_sums_over_campaigns(model):
    got = rows(reports.q2_advertiser_spending(*pick(model, "events", "campaigns", "advertisers"), START, END))
    assert got == [("A", 4, 1, D("11.05"), 25.0), ("B", 2, 2, D("6.00"), 100.0)]


def test_q3_no_clicks_come_first(model):
    got = rows(reports.q3_campaign_cpc_cpm(*pick(model, "events", "campaigns", "advertisers"), START, END))
    assert got == [("c2", "A", 2, 0, D("8.05"), None, 4025.0), ("c1", "A", 2, 1, D("3.00"), 3.0, 1500.0),
                   ("c3", "B", 2, 2, D("6.00"), 3.0, 3000.0)]


def test_q4_counts_clicked_events_of_known_places(model):
    got = rows(reports.q4_top_locations_by_revenue(*pick(model, "events", "locations"), START, END))
    assert got == [("USA", 3, D("11.00"))]


def test_q5_keeps_users_without_country_and_drops_unknown_users(model):
    got = rows(reports.q5_top_engaged_users(*pick(model, "events", "users", "locations"), START, END))
    assert got == [(100, 20, "F", "USA", 1), (101, 30, "M", None, 1)]


def test_q6_threshold_after_rounding(spark, model):
    advertisers = model["advertisers"]
    campaigns = spark.createDataFrame(
        [(1, 1, "exact", D("100.00")), (2, 1, "rounds down", D("100000.00")), (3, 1, "above", D("10000.00")),
         (4, 1, "no budget", D("0.00")), (5, 1, "no events", D("9.00"))],
        "campaign_id int, advertiser_id int, campaign_name string, budget decimal(14,2)")
    events = spark.createDataFrame(
        [(1, D("80.00")), (2, D("80004.00")), (3, D("8001.00")), (4, D("5.00"))],
        "campaign_id int, ad_cost decimal(12,2)")
    got = rows(reports.q6_near_budget_exhaustion(events, campaigns, advertisers))
    assert got == [("above", "A", D("10000.00"), D("8001.00"), 80.01)]


def test_q7(model):
    got = rows(reports.q7_ctr_by_device(*pick(model, "events", "devices"), START, END))
    assert got == [("Mobile", 3, 2, 66.6667), ("Desktop", 1, 0, 0.0)]


def test_bad_window_is_refused(model):
    with pytest.raises(ValueError):
        reports.q7_ctr_by_device(*pick(model, "events", "devices"), END, START)


def test_run_report_writes_csv_and_manifest(spark, model, tmp_path):
    frames = reports.campaign_report(**model, start=START, end=END, min_impressions=2)
    out = str(tmp_path / "report")
    manifest = run_report(spark, frames, START, END, out, generated_at=datetime(2024, 11, 2, 3, 4, 5))
    assert manifest["generated_at"] == "2024-11-02T03:04:05Z"
    assert manifest["analysis_window"] == {"start": "2024-10-01", "end": "2024-10-31"}
    q3 = manifest["queries"]["q3_campaign_cpc_cpm"]
    assert q3["row_count"] == 3 and q3["columns"][:2] == ["campaign_name", "advertiser"]
    lines = [json.loads(r["value"]) for r in spark.read.text(q3["rows_file"]).collect()]
    assert lines[0] == {"campaign_name": "c2", "advertiser": "A", "impressions": 2, "clicks": 0,
                        "total_cost": "8.05", "cpc": None, "cpm": 4025.0} and len(lines) == 3
    stored = json.loads(spark.read.text(f"{out}/report.json").first()[0])
    assert stored == manifest and len(stored["queries"]) == 7
    back = spark.read.option("header", True).csv(f"{out}/q3_campaign_cpc_cpm.csv")
    assert sorted(r["campaign_name"] for r in back.collect()) == ["c1", "c2", "c3"]


def test_manifest_rows_are_whole_for_any_report(spark, tmp_path):
    many = spark.range(1_500).select(F.col("id").alias("campaign"), (F.col("id") / 7).alias("cpm"))
    manifest = run_report(spark, {"many": ("Many campaigns", many)}, START, END, str(tmp_path / "r"))
    assert manifest["queries"]["many"]["row_count"] == 1_500
    assert spark.read.text(manifest["queries"]["many"]["rows_file"]).count() == 1_500


def test_report_equals_the_single_queries(model):
    frames = reports.campaign_report(**model, start=START, end=END, min_impressions=2)
    single = {
        "q1_top_campaigns_by_ctr": reports.q1_top_campaigns_by_ctr(
            *pick(model, "events", "campaigns", "advertisers"), START, END, 2),
        "q2_advertiser_spending": reports.q2_advertiser_spending(
            *pick(model, "events", "campaigns", "advertisers"), START, END),
        "q3_campaign_cpc_cpm": reports.q3_campaign_cpc_cpm(
            *pick(model, "events", "campaigns", "advertisers"), START, END),
        "q4_top_locations_by_revenue": reports.q4_top_locations_by_revenue(
            *pick(model, "events", "locations"), START, END),
        "q5_top_engaged_users": reports.q5_top_engaged_users(
            *pick(model, "events", "users", "locations"), START, END),
        "q6_near_budget_exhaustion": reports.q6_near_budget_exhaustion(
            *pick(model, "events", "campaigns", "advertisers")),
        "q7_ctr_by_device": reports.q7_ctr_by_device(*pick(model, "events", "devices"), START, END),
    }
    for key, df in single.items():
        assert rows(frames[key][1]) == rows(df), key


def test_engagement_counts_leave_out_unknown_campaigns(spark):
    events = spark.createDataFrame([(1, 10), (1, None), (1, 77), (1, 11), (2, None)], "user_id int, campaign_id int")
    campaigns = spark.createDataFrame([(10, 5), (11, 99)], "campaign_id int, advertiser_id int")
    advertisers = spark.createDataFrame([(5, "A")], "advertiser_id int, name string")
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id int")
    assert sorted(rows(lookups.user_engagement_counts(events, campaigns, advertisers, users))) == [(1, 1), (2, 0), (3, 0)]


def test_one_advertiser_reads_only_its_events(model):
    args = pick(model, "events", "campaigns", "advertisers")
    plan = lookups.advertiser_spending(*args, advertiser_id=1)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
    assert rows(lookups.advertiser_spending(*args, advertiser_id=1)) == [
        r for r in rows(lookups.advertiser_spending(*args)) if r[0] == 1]


def test_campaign_lookup_keeps_idle_campaigns(model):
    got = {r["campaign_id"]: tuple(r)[2:] for r in
           lookups.campaign_performance(*pick(model, "events", "campaigns")).collect()}
    assert got[4] == (0, 0, None, D("0.00")) and got[1] == (3, 2, 0.6667, D("7.00"))
    assert rows(lookups.campaign_performance(*pick(model, "events", "campaigns"), campaign_id=77)) == []
    assert len(rows(lookups.campaign_performance(*pick(model, "events", "campaigns"), campaign_id=1))) == 1


def test_advertiser_lookup_keeps_zeros(model):
    got = {r["advertiser_id"]: tuple(r)[1:] for r in
           lookups.advertiser_spending(*pick(model, "events", "campaigns", "advertisers")).collect()}
    assert got[3] == ("C", D("0.00"), 0, 0, D("0.00")) and got[1] == ("A", D("15.05"), 5, 2, D("12.00"))


def test_unknown_user_differs_from_user_without_events(model):
    args = pick(model, "events", "campaigns", "advertisers", "users")
    assert rows(lookups.user_engagement_counts(*args, user_id=103)) == [(103, 0)]
    assert rows(lookups.user_engagement_counts(*args, user_id=999)) == []
    assert rows(lookups.user_engagement_counts(*args, user_id=100, n=1)) == [(100, 1)]


def test_user_engagements_newest_first_per_user(model):
    got = lookups.user_engagements(*pick(model, "events", "campaigns", "advertisers", "users"), n=1).collect()
    assert sorted((r["user_id"], r["event_id"], r["campaign_name"]) for r in got) == [
        (100, "e2", "c1"), (101, "e3", "c1"), (102, "e4", "c2")]


@pytest.fixture(scope="module")
def flat(spark):
    return spark.createDataFrame(
        [
            ("e1", "C", "A", "US", 1, "USA", datetime(2024, 10, 1, 1), D("1.00"), True, D("2.00")),
            (None, "C", "A", "US", 1, "USA", datetime(2024, 10, 1, 2), D("1.00"), True, D("2.00")),
            ("e3", "C", "A", "US", 1, "USA", None, D("4.00"), False, D("0.00")),
            ("e4", None, "A", None, None, "UK", datetime(2024, 10, 2), D("8.00"), False, D("0.00")),
            (None, "D", "B", "US", 2, "USA", datetime(2024, 10, 3), D("1.00"), False, D("0.00")),
        ],
        "event_id string, campaign_name string, advertiser_name string, target_country string, user_id long, "
        "location string, event_timestamp timestamp_ntz, ad_cost decimal(12,2), was_clicked boolean, "
        "ad_revenue decimal(12,2)",
    ).withColumns({
        "event_date": F.to_date("event_timestamp"), "device": F.lit("Mobile"), "ad_slot_size": F.lit("1x2"),
        "click_timestamp": F.lit(None).cast("timestamp_ntz"),
    })


def test_daily_rollup_counts_ids_and_keeps_null_names(flat):
    got = {(r["campaign_name"], r["event_date"]): tuple(r)[2:] for r in er.campaign_performance_by_day(flat).collect()}
    assert got == {
        ("C", date(2024, 10, 1)): (1, 2, 2.0, D("2.00"), D("4.00")),
        (None, date(2024, 10, 2)): (1, 0, 0.0, D("8.00"), D("0.00")),
        ("D", date(2024, 10, 3)): (0, 0, 0.0, D("1.00"), D("0.00")),
    }


def test_user_ranking_counts_undated_events_and_skips_unknown_users(flat):
    assert rows(er.most_active_users(flat).orderBy("rank")) == [("global", 1, 4, 2, 2, 1), ("global", 2, 0, 0, 0, 2)]


def test_region_ranking(flat):
    got = er.high_spending_advertisers_by_region(flat).orderBy("region", "rank").collect()
    assert [(r["region"], r["advertiser_name"], r["total_spend"], r["rank"]) for r in got] == [
        (None, "A", D("8.00"), 1), ("US", "A", D("6.00"), 1), ("US", "B", D("1.00"), 2)]


def test_history_drops_rows_without_key_and_collapses_duplicates(flat):
    assert er.user_engagement_history(flat).count() == 3
    doubled = flat.unionByName(flat)
    assert er.user_engagement_history(doubled).count() == 3


def test_trailing_window_starts_at_midnight_and_has_no_end(spark):
    days = spark.createDataFrame(
        [("A", date(2024, 9, 30), D("1.00"), 1, 1, D("0.00")), ("A", date(2024, 10, 1), D("2.00"), 1, 1, D("0.00")),
         ("B", date(2024, 12, 1), D("2.00"), 1, 0, D("0.00"))],
        "advertiser_name string, event_date date, total_spend decimal(22,2), total_impressions long, "
        "total_clicks long, total_revenue decimal(22,2)")
    got = rows(er.top_advertisers_30d(days, date(2024, 10, 31)))
    assert [(r[0], r[1]) for r in got] == [("A", D("2.00")), ("B", D("2.00"))]


def test_days_add_up_to_the_total(flat):
    by_day = er.advertiser_spend_by_day(flat).groupBy("advertiser_name").agg(F.sum("total_spend").alias("s"))
    direct = flat.filter("event_date is not null").groupBy("advertiser_name").agg(F.sum("ad_cost").alias("s"))
    assert sorted(rows(by_day)) == sorted(rows(direct))


def test_variant_speedup_guards_empty_variants(spark):
    df = spark.createDataFrame(
        [("a", "db", D("4.00")), ("a", "db", D("2.00")), ("a", "hit", D("1.00")), ("b", "db", D("1.00"))],
        "label string, kind string, ms decimal(12,2)")
    got = {r["label"]: r for r in comparison.variant_speedup(df, "label", "kind", "ms", "db", "hit").collect()}
    assert (got["a"]["db_mean"], got["a"]["db_max"], got["a"]["speedup"]) == (3.0, D("4.00"), 3.0)
    assert got["b"]["hit_mean"] is None and got["b"]["speedup"] is None


def test_normalised_facts(spark, flat):
    advertisers = normalise.normalise_advertisers(flat)
    campaigns = normalise.normalise_campaigns(flat, advertisers)
    assert sorted(tuple(r)[:3] for r in campaigns.collect()) == [(1, 1, "C"), (2, 2, "D")]
    facts = normalise.normalise_events(flat, campaigns)
    assert sorted(r["campaign_id"] for r in facts.collect()) == [1, 1, 2]  # undated and nameless rows are gone


def test_interests_are_trimmed_and_distinct(spark):
    users = spark.createDataFrame([(1, "b, a,,b"), (2, " a "), (3, None)], "user_id int, interests string")
    assert sorted(rows(normalise.user_interests(users))) == [(1, 1), (1, 2), (2, 1)]
    piped = spark.createDataFrame([(1, "x|y")], "user_id int, interests string")
    assert sorted(rows(normalise.interest_names(piped, "|"))) == [(1, "x"), (1, "y")]
