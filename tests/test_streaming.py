"""Streams: equal to the batch result however the input is split, and safe to restart."""

import json
import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tallyworks import schemas
from tallyworks.plans import event_rollups as er, pages
from tallyworks.sinks.topics import messages
from tallyworks.sources.topics import read_topic
from tallyworks.streaming import counters, keyed_table, minutes
from tallyworks.streaming import pages as page_stream
from tallyworks.streaming.refresh import stream_refresh
from tallyworks.streaming.replay import replay, restamp

DOMAIN = pages.ALLOWED_DOMAINS[0]


def page(title, user=1, bot=False, domain=DOMAIN, dt="2024-05-01T10:00:00Z", **change):
    performer = {"user_id": user, "user_is_bot": bot}
    return json.dumps({"meta": {"domain": domain, "dt": dt}, "page_title": title, "performer": performer, **change})


FIRST = [
    page("A"), page("B", user=2), page("bot", bot=True), page("elsewhere", domain="de.wikipedia.org"),
    page("no flag", performer={"user_id": 3}), page("nobody", performer=None), "", "{broken", page(None),
    page("bad time", dt="soon"),
]
SECOND = [page("A", user=9), page("A", user=4), page("C", domain=pages.ALLOWED_DOMAINS[1])]


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def table_rows(df):
    return sorted(tuple(r) for r in df.select("domain", "page_title", "user_id").collect())


def batch_result(spark, lines):
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    rows = pages.page_creates(messages(pages.filter_page_creates(raw)))
    return table_rows(pages.page_creates_table(rows.dropna(subset=list(pages.PAGE_KEY))))


def test_filter_rules(spark):
    raw = spark.createDataFrame([(x,) for x in FIRST], "value string")
    kept = sorted((r["page_title"] or "") for r in pages.filter_page_creates(raw).collect())
    assert kept == ["", "A", "B", "bad time"]


def test_chain_equals_batch_and_resumes_without_loss_or_repeats(spark, tmp_path):
    topic, root = tmp_path / "input", str(tmp_path / "run")
    put(topic, "1.json", FIRST)
    first = page_stream.run_chain(spark, read_topic(spark, str(topic)), root)
    assert table_rows(first) == batch_result(spark, FIRST)
    put(topic, "2.json", SECOND)
    second = page_stream.run_chain(spark, read_topic(spark, str(topic)), root)
    assert table_rows(second) == batch_result(spark, FIRST + SECOND)
    assert spark.read.text(f"{root}/processed").count() == 7
    again = page_stream.run_chain(spark, read_topic(spark, str(topic)), root)
    assert table_rows(again) == table_rows(second) and spark.read.text(f"{root}/processed").count() == 7
    quarantined = spark.read.parquet(f"{root}/quarantine")
    assert sorted((r["page_title"] or "") for r in quarantined.collect()) == ["", "bad time"]


def test_split_of_the_input_does_not_matter(spark, tmp_path):
    topic = tmp_path / "input"
    for i, line in enumerate(FIRST + SECOND):
        put(topic, f"{i:02}.json", [line])
    source = read_topic(spark, str(topic), files_per_trigger=4)
    assert table_rows(page_stream.run_chain(spark, source, str(tmp_path / "run"))) == batch_result(spark, FIRST + SECOND)


def test_replayed_batch_replaces_itself(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k int, v int"
    for _ in range(2):
        keyed_table.append_batch(spark.createDataFrame([(1, 1), (2, 2)], schema), path, 1, 0, ["k"], [F.desc("v")])
    assert spark.read.parquet(path).count() == 2
    keyed_table.append_batch(spark.createDataFrame([(1, 5), (1, 4)], schema), path, 1, 1, ["k"], [F.desc("v")])
    assert sorted(map(tuple, keyed_table.read_latest(spark, path, ["k"]).collect())) == [(1, 5), (2, 2)]
    keyed_table.compact(spark, path, str(tmp_path / "c"), ["k"], ["k"])
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "c")).collect())) == [(1, 5), (2, 2)]


def test_new_checkpoint_does_not_overwrite_an_old_run(spark, tmp_path):
    topic, table = tmp_path / "processed", str(tmp_path / "table")
    for i in (1, 2):
        put(topic, f"{i}.json", [json.dumps(
            {"domain": "d", "created_at": "2024-01-01T00:00:00Z", "page_title": f"t{i}", "user_id": i})])
        source = read_topic(spark, str(topic))
        page_stream.stream_pages(source, table, str(tmp_path / f"ckpt{i}")).awaitTermination()
    assert [t for _, t, _ in table_rows(page_stream.read_pages(spark, table))] == ["t1", "t2"]


def test_a_later_checkpoint_beats_the_batches_of_an_earlier_one(spark, tmp_path):
    table, schema = str(tmp_path / "table"), "k int, v int"
    first = keyed_table.run_number(spark, table, "ckpt/b")
    for batch, value in enumerate((5, 6, 7)):
        keyed_table.append_batch(spark.createDataFrame([(1, value)], schema), table, first, batch, ["k"], [F.desc("v")])
    second = keyed_table.run_number(spark, table, "ckpt/a")
    assert (first, second, keyed_table.run_number(spark, table, "ckpt/b/")) == (1, 2, 1)
    keyed_table.append_batch(spark.createDataFrame([(1, 3)], schema), table, second, 0, ["k"], [F.desc("v")])
    assert [tuple(r) for r in keyed_table.read_latest(spark, table, ["k"]).collect()] == [(1, 3)]


def test_malformed_messages_of_the_first_hop_are_kept(spark, tmp_path):
    topic = tmp_path / "input"
    put(topic, "1.json", ['{"meta": {"dom', FIRST[0]])
    page_stream.run_chain(spark, read_topic(spark, str(topic)), str(tmp_path / "run"))
    assert [tuple(r) for r in spark.read.schema("value string, reason string").json(
        str(tmp_path / "run" / "malformed")).collect()] == [('{"meta": {"dom', "not JSON")]


def test_topic_from_an_instant_on(spark, tmp_path):
    topic = tmp_path / "topic"
    put(topic, "old.json", ["old"])
    later = datetime(2099, 1, 1, tzinfo=timezone.utc)
    os.utime(topic / "old.json", (1_600_000_000, 1_600_000_000))
    for i, (starting, expected) in enumerate((("earliest", 1), (later, 0), ("latest", 0))):
        out, ckpt = str(tmp_path / f"out{i}"), str(tmp_path / f"ckpt{i}")
        read_topic(spark, str(topic), starting).writeStream.format("parquet").option(
            "checkpointLocation", ckpt).trigger(availableNow=True).start(out).awaitTermination()
        assert spark.read.schema("value string").parquet(out).count() == expected


EVENT = "campaign_name string, event_timestamp timestamp_ntz, was_clicked boolean"


def events(spark, *rows):
    return spark.createDataFrame([(c, datetime.fromisoformat(t), w) for c, t, w in rows], EVENT)


def counter_rows(df):
    return sorted((r["campaign_name"], str(r["event_date"]), r["impressions"], r["clicks"]) for r in df.collect())


def run_counters(spark, tmp_path, watermark="1 day"):
    source = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    counters.stream_daily_counters(
        source, str(tmp_path / "table"), str(tmp_path / "ckpt"), watermark).awaitTermination()
    return counter_rows(counters.read_counters(spark, str(tmp_path / "table")))


def test_counters_grow_over_batches_and_restarts(spark, tmp_path):
    one = events(spark, ("c", "2024-01-01T01:00:00", True), ("c", "2024-01-01T23:59:59", False), ("d", "2024-01-02T00:00:00", False))
    two = events(spark, ("c", "2024-01-01T05:00:00", True), ("c", "2024-01-02T05:00:00", True))
    one.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert run_counters(spark, tmp_path) == counter_rows(counters.daily_counters(one))
    two.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert run_counters(spark, tmp_path) == counter_rows(counters.daily_counters(one.unionByName(two)))


def test_days_do_not_depend_on_the_session_zone(spark):
    df = events(spark, ("c", "2024-01-01T00:00:00", True), ("c", "2024-01-01T23:59:59", False))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert counter_rows(counters.daily_counters(df)) == [("c", "2024-01-01", 2, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_late_row_is_dropped(spark, tmp_path):
    on_time = events(spark, ("c", "2024-01-10T00:00:00", True))
    on_time.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run_counters(spark, tmp_path)
    late = events(spark, ("c", "2024-01-02T00:00:00", True), ("c", "2024-01-10T01:00:00", False))
    late.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert run_counters(spark, tmp_path) == [("c", "2024-01-10", 2, 1)]


def tweet(**fields):
    return json.dumps(fields)


def test_minute_rows(spark):
    raw = spark.createDataFrame([
        (tweet(customer_id="u", review_date="2024-05-01T23:59:30+02:00", review_body="hi, \"you\""),),
        (tweet(customer_id="v"),),
    ], "value string")
    now = F.lit(datetime(2024, 1, 2, 3, 4, 5)).cast("timestamp_ntz")
    assert sorted(map(tuple, minutes.minute_rows(raw, now).collect())) == [
        ("u", "2024-05-01T23:59:30+02:00", 'hi, "you"', "tweets_01_05_2024_23_59.csv"),
        ("v", "2024-01-02T03:04:05.000000", "", "tweets_02_01_2024_03_04.csv"),
    ]


def test_messages_without_a_minute_are_set_aside(spark):
    bad = [('{"customer_id":"u","revi',), (tweet(customer_id="v", review_date="yesterday"),), ("  ",)]
    raw = spark.createDataFrame(bad + [(tweet(customer_id="w", review_date="2024-05-01T10:00:01+00:00"),)], "value string")
    assert [r["author_id"] for r in minutes.minute_rows(raw).collect()] == ["w"]
    assert sorted(map(tuple, minutes.minute_quarantine(raw).collect())) == sorted(
        [(bad[0][0], "not JSON"), (bad[1][0], "unreadable time")])


def test_minute_files_append_with_one_header_each(spark, tmp_path):
    topic, out = tmp_path / "topic", str(tmp_path / "files")

    def run():
        minutes.stream_minute_files(read_topic(spark, str(topic)), out, str(tmp_path / "ckpt")).awaitTermination()
        stored = spark.read.option("header", True).csv(out)
        return sorted((r["author_id"], r[minutes.FILE_COLUMN]) for r in stored.collect())

    put(topic, "1", [tweet(customer_id="a", review_date="2024-05-01T10:00:01+00:00", review_body="x"),
                     tweet(customer_id="b", review_date="2024-05-01T10:01:01+00:00", review_body="y")])
    assert run() == [("a", "tweets_01_05_2024_10_00.csv"), ("b", "tweets_01_05_2024_10_01.csv")]
    put(topic, "2", [tweet(customer_id="c", review_date="2024-05-01T10:00:59+00:00", review_body="z")])
    assert run() == [("a", "tweets_01_05_2024_10_00.csv"), ("b", "tweets_01_05_2024_10_01.csv"),
                     ("c", "tweets_01_05_2024_10_00.csv")]


def test_replay_restamps_every_row(spark, tmp_path):
    header = schemas.REVIEWS_RAW.fieldNames()
    for i in range(3):
        values = ",".join(f"{c}{i}" for c in header)
        put(tmp_path / "in", f"{i}.csv", [",".join(header), values])
    now = F.lit(datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc))
    live = replay(spark, str(tmp_path / "in"), schemas.REVIEWS_RAW, "review_date", header=True, now=now)
    page_stream.stream_publish(live, str(tmp_path / "tweets"), str(tmp_path / "ckpt")).awaitTermination()
    sent = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "tweets")).collect()]
    assert len(sent) == 3 and {s["review_date"] for s in sent} == {"2024-01-02T03:04:05.000000+00:00"}
    assert sorted(s["review_id"] for s in sent) == ["review_id0", "review_id1", "review_id2"]


def test_restamp_uses_the_clock(spark):
    stamp = restamp(spark.range(1), "t").first()["t"]
    assert abs((datetime.now(timezone.utc) - datetime.fromisoformat(stamp)).total_seconds()) < 300


@pytest.mark.parametrize("runs", [1, 2])
def test_refresh_is_repeatable(spark, tmp_path, runs):
    schema = "campaign_name string, event_date date, event_id string, was_clicked boolean, " \
             "ad_cost decimal(12,2), ad_revenue decimal(12,2)"
    store, table = str(tmp_path / "events"), str(tmp_path / "daily")
    rows = [("c", "2024-01-01", "e1", True), ("c", "2024-01-01", "e2", False), ("c", "2024-01-02", "e3", False)]
    raw = spark.createDataFrame(rows, "campaign_name string, day string, event_id string, was_clicked boolean")
    raw.select("campaign_name", F.to_date("day").alias("event_date"), "event_id", "was_clicked",
               F.lit(1).cast("decimal(12,2)").alias("ad_cost"), F.lit(0).cast("decimal(12,2)").alias("ad_revenue")
               ).coalesce(1).write.parquet(store)

    def recompute(batch):
        touched = batch.select("event_date").distinct()
        stored = spark.read.schema(schema).parquet(store)
        return er.campaign_performance_by_day(stored.join(touched, "event_date", "left_semi"))

    for i in range(runs):
        source = spark.readStream.schema(schema).parquet(store)
        stream_refresh(source, recompute, table, str(tmp_path / f"ckpt{i}"), ["event_date"], ["campaign_name"],
                       every=None).awaitTermination()
    got = sorted((str(r["event_date"]), r["total_impressions"], r["total_clicks"])
                 for r in spark.read.parquet(table).collect())
    assert got == [("2024-01-01", 2, 1), ("2024-01-02", 1, 0)]
