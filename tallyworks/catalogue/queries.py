"""Every query over the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyworks.catalogue import views as v
from tallyworks.functions.calendar import months_touched
from tallyworks.functions.parsing import slot_size
from tallyworks.functions.serialise import plain_values
from tallyworks.operators import states as st
from tallyworks.operators.dictionary import grow, read_dictionary
from tallyworks.operators.integrity import cascade, orphan_report
from tallyworks.operators.keyed import insert_ignore, upsert
from tallyworks.operators.sampling import bounded_sample
from tallyworks.operators.surrogates import attach_ids, lookup_dimension
from tallyworks.plans import cleaning, comparison, event_rollups as er, jobs, lookups, normalise, pages, reports
from tallyworks.plans import review_rollups as rr, running_totals
from tallyworks.schemas import PAGE_CREATE
from tallyworks.session import scratch_path
from tallyworks.sinks.buckets import read_buckets, upsert_buckets
from tallyworks.sinks.reports import report_counts, report_rows as all_rows, write_report_csv
from tallyworks.sinks.tables import refresh_partitions, write_clustered
from tallyworks.sinks.topics import messages
from tallyworks.sinks.two_keys import write_two_keys
from tallyworks.sources import files
from tallyworks.sources.files import read_keyed
from tallyworks.sources.intake import intake_counts, parse_events
from tallyworks.sources.topics import read_topic
from tallyworks.streaming import counters, minutes
from tallyworks.streaming.closed_minutes import close_all, read_files, stream_closed_minutes
from tallyworks.streaming.counts import write_counts
from tallyworks.streaming.lateness import stream_timely_rollup
from tallyworks.streaming.newest import read_newest, stream_newest
from tallyworks.streaming.paced import replay_by_rows, write_numbered
from tallyworks.streaming.pages import read_pages, run_chain, stream_filter, stream_pages
from tallyworks.streaming.refresh import stream_refresh
from tallyworks.streaming.replay import replay
from tallyworks.streaming.rollups import read_rollup, stream_rollup

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries; the SQL side states the same values.
START, END = date(1997, 1, 1), date(1998, 12, 31)
AS_OF = date(2001, 10, 31)
MONTH_START, MONTH_END = date(1998, 3, 15), date(1999, 2, 10)
CAMPAIGN, PLACE = "Brand#7/PROMO", "NATION_3"
MONTH_RANGES = [
    (MONTH_START, MONTH_END), (date(1995, 1, 1), date(1995, 1, 31)), (date(1992, 1, 1), date(2001, 12, 31)),
    (date(1996, 11, 30), date(1997, 1, 1)), (date(1993, 6, 1), date(1993, 12, 31)),
]
PACE = 6_000
PRODUCT, CUSTOMER = "46", "46"
USER = 46
SAMPLE_ROWS = 25_000
HEAVY = 25


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared space."""
    return scratch_path(spark, name)


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream. The bracket makes the path a pattern, which may match a file or a folder."""
    schema = v.table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


# Campaign report

def q1_top_campaigns_by_ctr(spark, d, min_impressions: int = 100):
    facts = v.ad_facts(spark, d, "campaign_id", "timestamp", "was_clicked")
    return reports.q1_top_campaigns_by_ctr(
        facts, v.campaigns(spark, d), v.advertisers(spark, d), START, END, min_impressions)


def q2_advertiser_spending(spark, d):
    facts = v.ad_facts(spark, d, "campaign_id", "timestamp", "was_clicked", "ad_cost")
    return reports.q2_advertiser_spending(facts, v.campaigns(spark, d), v.advertisers(spark, d), START, END)


def q3_campaign_cpc_cpm(spark, d):
    facts = v.ad_facts(spark, d, "campaign_id", "timestamp", "was_clicked", "ad_cost")
    return reports.q3_campaign_cpc_cpm(facts, v.campaigns(spark, d), v.advertisers(spark, d), START, END)


def q4_top_locations_by_revenue(spark, d):
    facts = v.ad_facts(spark, d, "location_id", "timestamp", "was_clicked", "ad_revenue")
    return reports.q4_top_locations_by_revenue(facts, v.locations(spark, d), START, END)


def q5_top_engaged_users(spark, d):
    facts = v.ad_facts(spark, d, "user_id", "timestamp", "was_clicked")
    return reports.q5_top_engaged_users(facts, v.users(spark, d), v.locations(spark, d), START, END)


def q6_near_budget_exhaustion(spark, d):
    facts = v.ad_facts(spark, d, "campaign_id", "ad_cost")
    return reports.q6_near_budget_exhaustion(facts, v.campaigns(spark, d), v.advertisers(spark, d))


def q7_ctr_by_device(spark, d):
    facts = v.ad_facts(spark, d, "device_id", "timestamp", "was_clicked")
    return reports.q7_ctr_by_device(facts, v.devices(spark, d), START, END)


def _report(spark, d):
    by_campaign = v.ad_facts(spark, d, "campaign_id", "timestamp", "was_clicked", "ad_cost")
    by_group = v.ad_facts(spark, d, "location_id", "user_id", "device_id", "timestamp", "was_clicked", "ad_revenue")
    return reports.campaign_report(
        by_campaign, v.campaigns(spark, d), v.advertisers(spark, d), v.users(spark, d), v.locations(spark, d),
        v.devices(spark, d), START, END, by_group=by_group)


def report_manifest(spark, d):
    """Row counts of all seven reports, from two scans of the facts."""
    return report_counts(_report(spark, d))


def report_rows(spark, d):
    """The rows of all seven reports as JSON, from two scans of the facts; ratios as decimals, so that every
    engine writes them alike."""
    def exact(df):
        return df.withColumns({c: F.col(c).cast("decimal(24,4)") for c, kind in df.dtypes if kind == "double"})

    return all_rows({key: (title, exact(df)) for key, (title, df) in _report(spark, d).items()})


# Event rollups and the queries over them

_DAY = ("event_id", "event_date", "was_clicked", "ad_cost", "ad_revenue")


def campaign_performance_by_day(spark, d):
    return er.campaign_performance_by_day(v.ad_events(spark, d, "campaign_name", *_DAY))


def advertiser_spend_by_day(spark, d):
    return er.advertiser_spend_by_day(v.ad_events(spark, d, "advertiser_name", *_DAY))


def user_engagement_history(spark, d):
    return er.user_engagement_history(v.ad_events(spark, d))


def most_active_users(spark, d):
    return er.most_active_users(v.ad_events(spark, d, "event_id", "user_id", "was_clicked"))


def high_spending_advertisers_by_region(spark, d):
    return er.high_spending_advertisers_by_region(
        v.ad_events(spark, d, "event_id", "target_country", "advertiser_name", "was_clicked", "ad_cost", "ad_revenue"))


def campaign_daily_history(spark, d):
    return er.campaign_daily_history(campaign_performance_by_day(spark, d), CAMPAIGN)


def top_advertisers_30d(spark, d):
    return er.top_advertisers_30d(advertiser_spend_by_day(spark, d), AS_OF)


def last_ads_per_user(spark, d):
    return er.last_ads_per_user(user_engagement_history(spark, d))


def top_clickers_30d(spark, d):
    return er.top_clickers_30d(v.ad_events(spark, d, "user_id", "event_timestamp", "was_clicked"), AS_OF)


def top_advertisers_region_30d(spark, d):
    return er.top_advertisers_region_30d(
        v.ad_events(spark, d, "advertiser_name", "location", "event_timestamp", "ad_cost"), PLACE, AS_OF)


def events_clean(spark, d):
    return cleaning.clean_events(v.raw_ad_events(spark, d))


# Lookups

def campaign_performance(spark, d):
    facts = v.ad_facts(spark, d, "event_id", "campaign_id", "was_clicked", "ad_cost")
    return lookups.campaign_performance(facts, v.campaigns(spark, d))


def advertiser_spending(spark, d):
    facts = v.ad_facts(spark, d, "event_id", "campaign_id", "was_clicked", "ad_cost", "ad_revenue")
    return lookups.advertiser_spending(facts, v.campaigns(spark, d), v.advertisers(spark, d))


def user_engagements(spark, d):
    return lookups.user_engagements(
        v.ad_facts(spark, d), v.campaigns(spark, d), v.advertisers(spark, d), v.users(spark, d))


def user_engagement_counts(spark, d):
    return lookups.user_engagement_counts(
        v.dirty_facts(spark, d), v.campaigns(spark, d), v.advertisers(spark, d), v.users(spark, d))


def _advertiser(spark, d):
    """The id of the first advertiser by name."""
    return v.advertisers(spark, d).orderBy("name").first()["advertiser_id"]


def campaign_performance_one(spark, d):
    """One campaign; the key reaches the scan side of the aggregate."""
    facts = v.ad_facts(spark, d, "event_id", "campaign_id", "was_clicked", "ad_cost")
    campaigns = v.campaigns(spark, d)
    return lookups.campaign_performance(
        facts, campaigns, campaigns.orderBy("campaign_name").first()["campaign_id"])


def advertiser_spending_one(spark, d):
    facts = v.ad_facts(spark, d, "event_id", "campaign_id", "was_clicked", "ad_cost", "ad_revenue")
    return lookups.advertiser_spending(
        facts, v.campaigns(spark, d), v.advertisers(spark, d), _advertiser(spark, d))


def user_engagements_one(spark, d):
    return lookups.user_engagements(
        v.dirty_facts(spark, d), v.campaigns(spark, d), v.advertisers(spark, d), v.users(spark, d), USER)


# Reviews

def reviews_clean(spark, d):
    return cleaning.clean_reviews(v.raw_reviews(spark, d))


def reviews_clean_verified(spark, d):
    return cleaning.clean_verified_reviews(v.raw_reviews(spark, d))


def product_stats(spark, d):
    return rr.product_stats(
        v.verified_reviews(spark, d, "review_id", "product_id", "product_title", "star_rating"))


def customer_stats(spark, d):
    return rr.customer_stats(v.verified_reviews(spark, d, "review_id", "customer_id"))


def monthly_product_reviews(spark, d):
    return rr.monthly_product_reviews(v.verified_reviews(spark, d, "review_id", "product_id", "review_date"))


def reviews_by_product(spark, d):
    return rr.reviews_by_product(v.reviews(spark, d))


def reviews_by_customer(spark, d):
    return rr.reviews_by_customer(v.reviews(spark, d))


def product_monthly_counts(spark, d):
    return rr.product_monthly_counts(
        v.reviews(spark, d, "review_id", "product_id", "product_title", "review_date"))


_MONTHLY = ("review_id", "customer_id", "review_date")


def customer_verified_monthly(spark, d):
    return rr.customer_monthly(v.reviews(spark, d, *_MONTHLY, "verified_purchase"), rr.verified())


def customer_hater_monthly(spark, d):
    return rr.customer_monthly(v.reviews(spark, d, *_MONTHLY, "star_rating"), rr.low_rated())


def customer_backer_monthly(spark, d):
    return rr.customer_monthly(v.reviews(spark, d, *_MONTHLY, "star_rating"), rr.high_rated())


def top_products_by_reviews(spark, d):
    return rr.top_products_by_reviews(product_stats(spark, d))


def highly_rated_products(spark, d):
    return rr.highly_rated_products(product_stats(spark, d))


def top_reviewers(spark, d):
    return rr.top_reviewers(customer_stats(spark, d))


def heavy_reviewer_count(spark, d):
    return rr.heavy_reviewer_count(customer_stats(spark, d), HEAVY)


def top_product_trend(spark, d):
    return rr.top_product_trend(product_stats(spark, d), monthly_product_reviews(spark, d))


def monthly_volume(spark, d):
    return rr.monthly_volume(monthly_product_reviews(spark, d))


def most_reviewed(spark, d):
    return rr.most_reviewed(product_monthly_counts(spark, d), MONTH_START, MONTH_END)


def most_reviewed_ranges(spark, d):
    """The most-reviewed products of five ranges, from stored running totals."""
    path = _scratch(spark, "totals")
    totals = running_totals.running_totals(product_monthly_counts(spark, d), "product_id", "product_title")
    running_totals.write_running_totals(totals, path, "product_id")
    return running_totals.most_reviewed_in(files.read_table(spark, path), MONTH_RANGES)


def most_productive_customers(spark, d):
    return rr.most_productive_customers(customer_verified_monthly(spark, d), MONTH_START, MONTH_END)


def most_productive_haters(spark, d):
    return rr.most_productive_haters(customer_hater_monthly(spark, d), MONTH_START, MONTH_END)


def most_productive_backers(spark, d):
    return rr.most_productive_backers(customer_backer_monthly(spark, d), MONTH_START, MONTH_END)


# Normalisation

def lookup_dimension_keys(spark, d):
    """Dense ids of the review authors' names."""
    return lookup_dimension(v.table(spark, d, "customer"), "c_name", "name_id", "name")


def normalise_campaigns(spark, d):
    flat = v.table(spark, d, "part").select(
        F.concat_ws("/", "p_brand", "p_type").alias("campaign_name"), F.col("p_brand").alias("advertiser_name"))
    return normalise.normalise_campaigns(flat, normalise.normalise_advertisers(flat))


def normalise_events(spark, d):
    places = lookup_dimension(v.table(spark, d, "nation"), "n_name", "country_id", "country_name")
    gadgets = lookup_dimension(v.table(spark, d, "orders"), "o_orderpriority", "device_id", "device_name")
    flat = v.ad_events(spark, d, "event_id", "campaign_name", "user_id", "location", "device",
                       "event_timestamp", "bid_amount", "ad_cost", "was_clicked", "click_timestamp", "ad_revenue")
    return normalise.normalise_events(flat, normalise_campaigns(spark, d), places, gadgets)


def user_interests(spark, d):
    return normalise.user_interests(v.users(spark, d))


def surrogate_lookup(spark, d):
    """Orders by part name: every name stands for several parts and takes the last one; the names of
    small parts are not in the dictionary."""
    part = v.table(spark, d, "part")
    named = part.select(F.col("p_partkey").alias("l_partkey"), _labelled().alias("label"))
    facts = v.table(spark, d, "lineitem").select("l_partkey").join(named, "l_partkey").select("label")
    known = part.filter(F.col("p_size") > 5).select(_labelled().alias("label"), F.col("p_partkey").alias("part_id"))
    return attach_ids(facts, "label", known, "label", "part_id").groupBy("part_id").agg(
        F.count(F.lit(1)).alias("rows"))


def _labelled():
    return F.concat_ws(" ", "p_name", "p_size")


def fk_orphans(spark, d):
    facts = v.ad_facts(spark, d, "campaign_id", "user_id", "location_id", "device_id")
    campaigns, advertisers, users = v.campaigns(spark, d), v.advertisers(spark, d), v.users(spark, d)
    places, solvent = v.locations(spark, d), v.solvent_users(spark, d)
    pairs = normalise.interest_names(users)
    known = pairs.filter(F.col("interest_name") != "credit").select("interest_name").distinct()
    return orphan_report([
        ("ad_events.campaign_id", facts, "campaign_id", campaigns, "campaign_id"),
        ("ad_events.user_id", facts, "user_id", users, "user_id"),
        ("ad_events.user_id (solvent)", facts, "user_id", solvent, "user_id"),
        ("ad_events.location_id", facts, "location_id", places, "country_id"),
        ("ad_events.device_id", facts, "device_id", v.devices(spark, d), "device_id"),
        ("campaigns.advertiser_id", campaigns, "advertiser_id", advertisers, "advertiser_id"),
        ("users.country_id", users, "country_id", places, "country_id"),
        ("advertisers.country_id", advertisers.select((F.col("advertiser_id") % 30).alias("country_id")), "country_id",
         places, "country_id"),
        ("campaigns.slot_id", campaigns.select((F.col("campaign_id") % 60).alias("slot_id")), "slot_id",
         slot_dimension(spark, d), "slot_id"),
        ("user_interests.user_id (solvent)", pairs, "user_id", solvent, "user_id"),
        ("user_interests.interest", pairs, "interest_name", known, "interest_name"),
    ])


def cascade_survivors(spark, d):
    return cascade(normalise.interest_names(v.users(spark, d)), [("user_id", v.solvent_users(spark, d))])


def parse_slot(spark, d):
    """Slot texts of parts: well-formed, with blanks, in upper case, with three parts and without any."""
    text = (
        F.when(F.col("p_type") == "SMALL", F.concat("p_size", F.lit("X"), "p_size"))
        .when(F.col("p_type") == "LARGE", F.concat_ws("x", "p_size", "p_size", "p_size"))
        .when(F.col("p_type") == "PROMO", F.concat(F.lit(" "), "p_size", F.lit(" x"), "p_size", F.lit(" ")))
        .when(F.col("p_type") != "MEDIUM", F.concat_ws("x", "p_size", F.col("p_size") * 2))
    )
    sized = v.table(spark, d, "part").select("p_partkey", text.alias("slot_text"))
    return sized.withColumn("slot", slot_size("slot_text")).select(
        "p_partkey", "slot_text", "slot.width", "slot.height")


# Keyed tables, samples and messages

def sample_first_n(spark, d):
    facts = v.table(spark, d, "lineitem")
    order = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return bounded_sample(facts, SAMPLE_ROWS, order)


def insert_ignore_users(spark, d):
    """Solvent customers, plus every customer found in the orders by its first order."""
    customer = v.table(spark, d, "customer").filter(F.col("c_acctbal") >= 0)
    target = customer.select(F.col("c_custkey").alias("user_id"), F.lit("customer").alias("source"))
    new = v.table(spark, d, "orders").select(
        F.col("o_custkey").alias("user_id"), F.concat(F.lit("order "), "o_orderkey").alias("source"),
        "o_orderdate", "o_orderkey")
    first = [F.asc("o_orderdate"), F.asc("o_orderkey")]
    padded = target.withColumns({
        "o_orderdate": F.lit(None).cast("timestamp_ntz"), "o_orderkey": F.lit(None).cast("bigint")})
    return insert_ignore(padded, new, ["user_id"], first).select("user_id", "source")


def upsert_last_wins(spark, d):
    """The latest order of every customer: finished orders are stored, all others come in as changes."""
    orders = v.table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_orderpriority")
    stored = orders.filter(F.col("o_orderstatus") == "F")
    changes = orders.filter(F.col("o_orderstatus") != "F")
    return upsert(stored, changes, ["o_custkey"], ["o_orderdate", "o_orderkey"])


def _web_events(spark, d):
    return v.table(spark, d, "events")


def json_intake_counts(spark, d):
    return intake_counts(v.intake_messages(_web_events(spark, d)), PAGE_CREATE)


def publish_json(spark, d):
    """Whole review rows as they go to a topic."""
    return messages(v.reviews(spark, d))


def variant_speedup(spark, d):
    """Order values by priority: lines shipped against lines open."""
    lines = v.table(spark, d, "lineitem").select(
        "l_orderkey", F.when(F.col("l_linestatus") == "O", "open").otherwise("shipped").alias("variant"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"))
    labels = v.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("label"))
    return comparison.variant_speedup(lines.join(labels, "l_orderkey"), "label", "variant", "amount", "shipped", "open")


def months_in_range(spark, d):
    """The months covered by the shipping dates."""
    bounds = v.table(spark, d, "lineitem").agg(
        F.to_date(F.min("l_shipdate")).alias("first"), F.to_date(F.max("l_shipdate")).alias("last"))
    month = bounds.select(F.explode(months_touched(F.col("first"), F.col("last"))).alias("m"))
    return month.select(F.year("m").alias("year"), F.month("m").alias("month"))


# Page events and short messages

def wiki_filtered(spark, d):
    return pages.filter_page_creates(v.page_messages(_web_events(spark, d)), v.WEB_DOMAINS)


def _as_wall_clock(df):
    return df.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


def wiki_page_creates(spark, d):
    processed = messages(wiki_filtered(spark, d))
    return _as_wall_clock(pages.page_creates_table(pages.page_creates(processed)))


def stream_page_creates(spark, d):
    """The same table through the two streaming hops."""
    source = v.page_messages(_stream(spark, d, "events"))
    return _as_wall_clock(run_chain(spark, source, _scratch(spark, "pages"), v.WEB_DOMAINS))


def minute_buckets(spark, d):
    return minutes.bucket_counts(minutes.minute_rows(v.dirty_tweets(v.table(spark, d, "events"))))


def minute_quarantine(spark, d):
    """The short messages that belong to no minute, with the reason."""
    return minutes.minute_quarantine(v.dirty_tweets(v.table(spark, d, "events")))


def campaign_day_counters(spark, d):
    events = v.ad_events(spark, d, "campaign_name", "event_timestamp", "was_clicked")
    return counters.daily_counters(events)


def stream_campaign_day_counters(spark, d):
    """The same counters from a stream of line items joined to the parts.

    What is there at the start is one batch, in which no row is late; the watermark of a day closes days after it.
    """
    out = _scratch(spark, "counters")
    part = v.table(spark, d, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.concat_ws("/", "p_brand", "p_type").alias("campaign_name"))
    lines = _stream(spark, d, "lineitem").select("l_partkey", "l_shipdate", "l_returnflag")
    events = lines.join(part, "l_partkey").select(
        "campaign_name", F.col("l_shipdate").alias("event_timestamp"),
        (F.col("l_returnflag") == "R").alias("was_clicked"))
    counters.stream_daily_counters(events, f"{out}/table", f"{out}/ckpt").awaitTermination()
    return counters.read_counters(spark, f"{out}/table")


def replay_restamped(spark, d):
    """All web events replayed as a stream of whole-row messages and read back: every field, and whether a time of
    sending stands beside them."""
    out = _scratch(spark, "replay")
    schema = T.StructType(list(v.table(spark, d, "events").schema))
    live = replay(spark, f"{d}/events.parque[t]", schema, "sent_at", "parquet", files_per_trigger=4)
    query = (
        messages(plain_values(live)).writeStream.format("text")
        .option("checkpointLocation", f"{out}/ckpt").trigger(availableNow=True).start(f"{out}/topic"))
    query.awaitTermination()
    sent = spark.read.text(f"{out}/topic")
    back = sent.select(F.from_json("value", schema.add("sent_at", "string")).alias("e")).select("e.*")
    return back.withColumn("stamped", F.try_to_timestamp("sent_at").isNotNull()).drop("sent_at")


def paced_replay(spark, d):
    """All web events sent in order of time, 6,000 a tick, and read back: the tick of each, and that it was stamped."""
    out = _scratch(spark, "paced")
    events = v.table(spark, d, "events")
    write_numbered(events, ["ts", "event_id"], f"{out}/numbered")
    replay_by_rows(spark, f"{out}/numbered", f"{out}/topic", f"{out}/ckpt", "sent_at", PACE, "0 seconds")
    schema = T.StructType([*events.schema, T.StructField("sent_at", T.StringType())])
    sent = spark.read.text(f"{out}/topic").select("batch", F.from_json("value", schema).alias("e"))
    return sent.select("batch", "e.*").withColumn("stamped", F.try_to_timestamp("sent_at").isNotNull()).drop("sent_at")


# Stored tables

def keyed_month_read(spark, d):
    """The rollup stored by month and read back for one month, most-reviewed products first."""
    path = _scratch(spark, "months")
    write_clustered(product_monthly_counts(spark, d), path, ["year", "month"],
                    [F.desc("review_count"), "product_id", "product_title"])
    return read_keyed(spark, path, year=MONTH_START.year, month=MONTH_START.month)


def refreshed_rollup(spark, d):
    """A yearly rollup stored with all events, then refreshed from 1999 on with the clicked ones alone:
    earlier years stay as they were."""
    path = _scratch(spark, "refresh")
    yearly = v.ad_events(spark, d, "event_id", "event_timestamp", "was_clicked").withColumn(
        "year", F.year("event_timestamp"))
    rollup = [F.count("event_id").alias("events")]
    refresh_partitions(yearly.groupBy("year").agg(*rollup), path, ["year"])
    changed = yearly.filter(F.col("was_clicked") & (F.col("event_timestamp") >= F.lit("1999-01-01").cast("timestamp_ntz")))
    refresh_partitions(changed.groupBy("year").agg(*rollup), path, ["year"])
    return spark.read.parquet(path)


def cleaning_counts(spark, d):
    """Reviews before and after cleaning, counted while they are stored."""
    seen = jobs.store_clean(v.raw_reviews(spark, d), cleaning.clean_reviews, _scratch(spark, "clean"))
    return spark.range(1).select(
        F.lit(seen["raw"]).cast("bigint").alias("raw_rows"), F.lit(seen["rows"]).cast("bigint").alias("clean_rows"))


def quarantined_messages(spark, d):
    """Messages that are no JSON, with the reason."""
    return parse_events(v.intake_messages(_web_events(spark, d)), PAGE_CREATE)[1]


def plain_rows(spark, d):
    """Events as they leave for JSON consumers: ISO times and plain numbers."""
    return plain_values(v.ad_events(
        spark, d, "event_id", "event_timestamp", "event_date", "click_timestamp", "ad_cost", "ad_revenue"))


def slot_dimension(spark, d):
    """The distinct slot sizes of the parts with dense ids."""
    sized = v.table(spark, d, "part").select(F.concat_ws("x", "p_size", F.col("p_size") * 2).alias("slot_text"))
    return normalise.normalise_slots(sized, "slot_text")


def product_reviews_rated(spark, d):
    """The five-star reviews of one product."""
    return rr.reviews_by_product(v.reviews(spark, d), PRODUCT, 5)


def customer_reviews(spark, d):
    """All reviews of one customer."""
    return rr.reviews_by_customer(v.reviews(spark, d), CUSTOMER)


def csv_round_trip(spark, d):
    """The raw reviews written as CSV, read back and cleaned."""
    path = _scratch(spark, "csv")
    v.raw_reviews(spark, d).write.option("header", True).option("escape", '"').csv(path)
    return cleaning.clean_reviews(files.read_reviews(spark, path))


def secondary_key_read(spark, d):
    """Events stored in the order of their place and read back for one place."""
    path = _scratch(spark, "places")
    events = v.ad_events(spark, d, "event_id", "user_id", "location", "event_timestamp", "ad_cost")
    write_clustered(events, path, sort_cols=["location", "event_id"])
    return read_keyed(spark, path, location=PLACE)


def stream_refreshed_rollup(spark, d):
    """The yearly rollup, recomputed from the stored events for the years that arriving lines touch."""
    out = _scratch(spark, "refresh")
    events = v.ad_events(spark, d, "event_id", "event_timestamp").withColumn("year", F.year("event_timestamp"))

    def touched(batch):
        return batch.select(F.year("l_shipdate").alias("year")).distinct()

    def recompute(batch):
        return events.join(touched(batch), "year", "left_semi").groupBy("year").agg(F.count("event_id").alias("events"))

    stream_refresh(_stream(spark, d, "lineitem"), recompute, f"{out}/table", f"{out}/ckpt", ["year"], every=None,
                   touched=touched).awaitTermination()
    return spark.read.parquet(f"{out}/table")


def stream_resumed_pages(spark, d):
    """The page table of a chain that is stopped after half of the input and resumed when the rest has come."""
    root = _scratch(spark, "resumed")
    events = v.table(spark, d, "events")
    for half in (0, 1):
        events.filter(F.col("event_id") % 2 == half).write.mode("append").parquet(f"{root}/inbox")
        source = v.page_messages(spark.readStream.schema(events.schema).parquet(f"{root}/inbox"))
        table = run_chain(spark, source, root, v.WEB_DOMAINS)
    return _as_wall_clock(table)


def stream_compacted_pages(spark, d):
    """The page table of three batches and two checkpoints, folded after the second and the third batch."""
    root = _scratch(spark, "folded")
    events = v.table(spark, d, "events")
    for third in range(3):
        events.filter(F.col("event_id") % 3 == third).write.mode("append").parquet(f"{root}/inbox")
        source = v.page_messages(spark.readStream.schema(events.schema).parquet(f"{root}/inbox"))
        stream_filter(source, f"{root}/processed", f"{root}/ckpt/filter", v.WEB_DOMAINS).awaitTermination()
        # The last batch comes under a checkpoint of its own, which reads the whole topic again.
        stream_pages(read_topic(spark, f"{root}/processed"), f"{root}/pages", f"{root}/ckpt/pages{third // 2}",
                     fold_every=None if third == 0 else 1).awaitTermination()
    return _as_wall_clock(read_pages(spark, f"{root}/pages"))


def incremental_daily_rollup(spark, d):
    """The daily campaign rollup brought forward by three batches of line items; no earlier fact is read again."""
    root, rollup = _scratch(spark, "states"), er.campaign_day_rollup()
    lines = v.table(spark, d, "lineitem")
    for third in range(3):
        lines.filter(F.col("l_orderkey") % 3 == third).write.mode("append").parquet(f"{root}/inbox")
        stream_rollup(
            spark.readStream.schema(lines.schema).parquet(f"{root}/inbox"), rollup, f"{root}/table", f"{root}/ckpt",
            fold_every=2, prepare=lambda batch: v.ad_events_of(spark, d, batch, "campaign_name", "event_timestamp", *_DAY),
        ).awaitTermination()
    return er.campaign_performance_from_states(read_rollup(spark, f"{root}/table", rollup))


def _thirds(spark, d, name: str, key: str, root: str):
    """The table as three batches that come one after another, each with rows of all times."""
    rows = v.table(spark, d, name)
    for third in range(3):
        rows.filter(F.col(key) % 3 == third).write.mode("append").parquet(f"{root}/inbox")
        yield spark.readStream.schema(rows.schema).parquet(f"{root}/inbox")


def late_counter_rows(spark, d):
    """Daily counters of three batches in which days close 400 days after the latest event, and the rows that came too late."""
    root = _scratch(spark, "late")
    counts = st.Rollup(("campaign_name", "event_date"), {
        "impressions": st.counted("event_id"), "clicks": st.true_counted("was_clicked")})
    for lines in _thirds(spark, d, "lineitem", "l_orderkey", root):
        events = v.ad_events_of(spark, d, lines, "campaign_name", "event_timestamp", "event_date", "event_id", "was_clicked")
        stream_timely_rollup(events, counts, f"{root}/table", f"{root}/late", f"{root}/ckpt", "event_timestamp",
                             timedelta(days=1), timedelta(days=400), fold_every=2).awaitTermination()
    counted = read_rollup(spark, f"{root}/table", counts)
    late = counts.of(spark.read.parquet(f"{root}/late"))
    return counted.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))


def stream_last_ads(spark, d):
    """The ten newest ads of every user, kept by a stream whose events come in no order of time."""
    root = _scratch(spark, "last-ads")
    columns = ("user_id", *_DAY, "event_timestamp", "campaign_name", "advertiser_name", "ad_slot_size", "device", "location",
               "click_timestamp")
    for lines in _thirds(spark, d, "lineitem", "l_orderkey", root):
        rows = er.history_rows(v.ad_events_of(spark, d, lines, *columns)).select(*er.LAST_ADS)
        stream_newest(rows, f"{root}/table", f"{root}/ckpt", ["user_id"], "event_timestamp", ["event_id"], 10,
                      fold_every=2).awaitTermination()
    return read_newest(spark, f"{root}/table", ["user_id"], "event_timestamp", ["event_id"], 10)


def stream_minute_files(spark, d):
    """The minute files of three batches, five minutes after which a minute closes, read back, and what was set aside.

    The month of the given events is played in half an hour, so that a minute holds a day of them.
    """
    root = _scratch(spark, "minute-files")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    played = F.timestamp_add("SECOND", F.floor(F.timestamp_diff("SECOND", start, "ts") / 1440), start)
    for events in _thirds(spark, d, "events", "event_id", root):
        stream_closed_minutes(v.dirty_tweets(events.withColumn("ts", played)), f"{root}/minutes", f"{root}/ckpt",
                              timedelta(minutes=5)).awaitTermination()
    close_all(spark, f"{root}/minutes")
    aside = spark.read.parquet(f"{root}/minutes/quarantine").select(
        F.lit("").alias("author_id"), F.lit("").alias("created_at"), F.col("value").alias("text"),
        F.col("reason").alias(minutes.FILE_COLUMN))
    return read_files(spark, f"{root}/minutes").unionByName(aside)


def stream_write_counts(spark, d):
    """Rows received, written and set aside by each batch of the page stream, under two checkpoints.

    Pages of a value above 300 have no title and so no place in the table.
    """
    root = _scratch(spark, "counts")
    page = F.struct(F.col("event_type").alias("domain"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_at"),
                    F.when(F.col("value") <= 300, F.get_json_object("props", "$.k")).alias("page_title"), "user_id")
    for third, events in enumerate(_thirds(spark, d, "events", "event_id", root)):
        stream_pages(events.select(F.to_json(page).alias("value")), f"{root}/pages", f"{root}/ckpt{third // 2}",
                     f"{root}/quarantine", count=True).awaitTermination()
    return write_counts(spark, f"{root}/pages")


def two_key_read(spark, d):
    """Events stored once for look-ups by user and by place, read back for one of each."""
    path = _scratch(spark, "two-keys")
    events = v.ad_events(spark, d, "event_id", "user_id", "location", "event_timestamp", "ad_cost")
    write_two_keys(events, path, "user_id", "location")
    by_user = read_keyed(spark, path, user_id=USER).withColumn("asked", F.lit("user"))
    return by_user.unionByName(read_keyed(spark, path, location=PLACE).withColumn("asked", F.lit("place")))


def report_csv_round_trip(spark, d):
    """The reports written as headed CSV files and read back, as text."""
    out = _scratch(spark, "report")
    rows = None
    for key, (_, df) in _report(spark, d).items():
        exact = df.withColumns({c: F.col(c).cast("decimal(24,4)") for c, kind in df.dtypes if kind == "double"})
        write_report_csv(exact, f"{out}/{key}.csv")
        back = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in df.columns])).option(
            "header", True).option("enforceSchema", False).csv(f"{out}/{key}.csv")
        one = back.select(F.lit(key).alias("query"), F.to_json(F.struct(*back.columns), {"ignoreNullFields": "false"})
                          .alias("row_json"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


def bucketed_upsert(spark, d):
    """The last order of every customer, kept in buckets: orders before 1996, then the later ones of some customers."""
    path = _scratch(spark, "buckets")
    orders = v.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    early = F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")
    upsert_buckets(orders.filter(early), path, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    later = orders.filter(~early & (F.col("o_custkey") % 7 == 0))
    upsert_buckets(later, path, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return read_buckets(spark, path)


def growing_dictionary(spark, d):
    """Campaign names with ids that a second, larger load does not change."""
    path = _scratch(spark, "names")
    names = v.table(spark, d, "part").select("p_size", F.concat_ws("/", "p_brand", "p_type").alias("campaign"))
    grow(names.filter(F.col("p_size") <= 2), "campaign", path)
    grow(names, "campaign", path)
    return read_dictionary(spark, path)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        q1_top_campaigns_by_ctr, q2_advertiser_spending, q3_campaign_cpc_cpm, q4_top_locations_by_revenue,
        q5_top_engaged_users, q6_near_budget_exhaustion, q7_ctr_by_device, report_manifest, report_rows,
        campaign_performance_by_day, advertiser_spend_by_day, user_engagement_history, most_active_users,
        high_spending_advertisers_by_region, campaign_daily_history, top_advertisers_30d, last_ads_per_user,
        top_clickers_30d, top_advertisers_region_30d, events_clean,
        campaign_performance, advertiser_spending, user_engagements, user_engagement_counts,
        campaign_performance_one, advertiser_spending_one, user_engagements_one,
        reviews_clean, reviews_clean_verified, product_stats, customer_stats, monthly_product_reviews,
        reviews_by_product, reviews_by_customer, product_monthly_counts, customer_verified_monthly,
        customer_hater_monthly, customer_backer_monthly, top_products_by_reviews, highly_rated_products,
        top_reviewers, heavy_reviewer_count, top_product_trend, monthly_volume, most_reviewed,
        most_productive_customers, most_productive_haters, most_productive_backers,
        normalise_campaigns, normalise_events, user_interests, surrogate_lookup, fk_orphans, cascade_survivors,
        parse_slot, sample_first_n, upsert_last_wins, json_intake_counts, publish_json, variant_speedup,
        months_in_range, wiki_filtered, wiki_page_creates, stream_page_creates, minute_buckets, minute_quarantine,
        campaign_day_counters, stream_campaign_day_counters, replay_restamped,
        keyed_month_read, refreshed_rollup, cleaning_counts, quarantined_messages, plain_rows, slot_dimension,
        product_reviews_rated, customer_reviews, csv_round_trip, secondary_key_read, stream_refreshed_rollup,
        stream_resumed_pages, stream_compacted_pages, incremental_daily_rollup, bucketed_upsert, growing_dictionary,
        late_counter_rows, stream_last_ads, stream_minute_files, stream_write_counts,
        two_key_read, report_csv_round_trip, most_reviewed_ranges, paced_replay,
    )
}
QUERIES["lookup_dimension"] = lookup_dimension_keys
QUERIES["insert_ignore"] = insert_ignore_users
