"""Month ranges from running totals, replay paced by rows, and what a bounded sample stores."""

import json
import os
import random
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyworks.operators.sampling import bounded_sample
from tallyworks.plans import review_rollups as rr, running_totals as rt
from tallyworks.streaming import paced
from tallyworks.streaming.paced import replay_by_rows, write_numbered


@pytest.fixture(scope="module")
def monthly(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice(["x", "y", None]), rng.choice([2019, 2020, 2021]),
             rng.randint(1, 12), rng.randint(1, 9)) for _ in range(60)] + [("late", "z", 2021, 12, 1)]
    df = spark.createDataFrame(rows, "product_id string, product_title string, year int, month int, review_count long")
    return df.groupBy("product_id", "product_title", "year", "month").agg(F.sum("review_count").alias("review_count"))


@pytest.fixture(scope="module")
def stored(spark, monthly, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("totals") / "t")
    rt.write_running_totals(rt.running_totals(monthly, "product_id", "product_title"), path, "product_id")
    return spark.read.parquet(path)


@pytest.mark.parametrize("start,end", [
    ("2019-01-01", "2021-12-31"), ("2020-02-29", "2020-02-29"), ("2019-12-31", "2020-01-01"),
    ("2010-01-01", "2018-12-31"), ("2022-05-01", "2023-01-01"), ("2021-12-05", "2030-01-01"),
])
def test_ranges_equal_a_scan_of_the_months(monthly, stored, start, end):
    want = [tuple(r) for r in rr.most_reviewed(monthly, start, end, 50).collect()]
    assert [tuple(r) for r in rt.most_reviewed(stored, start, end, 50).collect()] == want


def test_one_row_per_key_holds_in_a_month(stored):
    held = stored.filter((F.col("from_month") <= 2021 * 12 + 12) & (F.col("until_month") > 2021 * 12 + 12))
    assert held.count() == held.select("product_id").distinct().count() == 5


def test_months_between_are_not_read(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = rt.range_counts(stored, "product_id", date(2019, 5, 1), date(2021, 3, 1))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    folders, pushed = re.findall(r"PartitionFilters: \[(.*?)\]", plan), re.findall(r"PushedFilters: \[(.*?)\]", plan)
    assert len(folders) == len(pushed) == 2  # the two ends of the range
    assert all("from_month" in f for f in folders) and all("GreaterThan(until_month" in p for p in pushed)


def test_bounds_and_empty_input(monthly):
    with pytest.raises(ValueError):
        rt.most_reviewed(rt.running_totals(monthly, "product_id", "product_title"), "2020-01-01", "2020-02-01", 501)
    none = rt.running_totals(monthly.limit(0), "product_id", "product_title")
    assert rt.most_reviewed(none, "2020-01-01", "2020-02-01").collect() == []


def sent(topic):
    out = {}
    for folder in sorted(os.listdir(topic)):
        lines = []
        for name in sorted(os.listdir(f"{topic}/{folder}")):
            if name.startswith("part-"):
                with open(f"{topic}/{folder}/{name}") as f:
                    lines += [json.loads(line) for line in f]
        out[folder] = lines
    return out


def test_pace_is_rows_and_a_second_run_sends_nothing(spark, tmp_path):
    df = spark.range(25).select((24 - F.col("id")).alias("k"), F.lit("old").alias("at")).repartition(7)
    write_numbered(df, ["k"], str(tmp_path / "n"))
    topic = str(tmp_path / "topic")
    for _ in range(2):
        replay_by_rows(spark, str(tmp_path / "n"), topic, str(tmp_path / "ckpt"), "at", 10, "0 seconds")
        got = sent(topic)
        assert [[m["k"] for m in got[b]] for b in sorted(got)] == [list(range(10)), list(range(10, 20)), list(range(20, 25))]
        assert all(m["at"] != "old" for b in got.values() for m in b)


def test_ticks_without_a_pause_share_a_batch_and_keep_their_rows(spark, tmp_path):
    write_numbered(spark.range(205).select((204 - F.col("id")).alias("k"), F.lit("old").alias("at")), ["k"], str(tmp_path / "n"))
    topic = str(tmp_path / "topic")
    replay_by_rows(spark, str(tmp_path / "n"), topic, str(tmp_path / "ckpt"), "at", 5, "0 seconds")
    got = sent(topic)
    assert list(got) == [f"batch={b:09d}" for b in range(41)]
    assert [[m["k"] for m in ticks] for ticks in got.values()] == [list(range(k, k + 5)) for k in range(0, 205, 5)]
    assert len([name for name in os.listdir(tmp_path / "ckpt" / "offsets") if name.isdigit()]) < 5  # 42 ticks one by one


def test_ticks_with_a_pause_are_sent_one_by_one(spark, tmp_path):
    write_numbered(spark.range(6).select(F.col("id").alias("k"), F.lit("old").alias("at")), ["k"], str(tmp_path / "n"))
    topic = str(tmp_path / "topic")
    replay_by_rows(spark, str(tmp_path / "n"), topic, str(tmp_path / "ckpt"), "at", 2, "300 milliseconds")
    got = sent(topic)
    assert [[m["k"] for m in got[b]] for b in sorted(got)] == [[0, 1], [2, 3], [4, 5]]
    assert len({ticks[0]["at"] for ticks in got.values()}) == 3


@pytest.mark.parametrize("first_tick,later_pace,later_tick", [
    ("0 seconds", 10, "0 seconds"), ("0 seconds", 7, "0 seconds"), ("0 seconds", 10, "1 millisecond"), ("1 millisecond", 10, "0 seconds"),
    ("1 millisecond", 7, "0 seconds")])
def test_a_stopped_replay_loses_and_repeats_nothing(spark, tmp_path, monkeypatch, first_tick, later_pace, later_tick):
    monkeypatch.setattr(paced, "TICKS_AT_ONCE", 3)
    write_numbered(spark.range(101).select(F.col("id").alias("k"), F.lit("old").alias("at")), ["k"], str(tmp_path / "n"))
    topic, moved, real = str(tmp_path / "topic"), [], paced._send_drafts

    def breaks(*args):
        real(*args)
        moved.append(1)
        if len(moved) == 2:
            raise RuntimeError("stopped after the ticks were sent, before they were noted")

    monkeypatch.setattr(paced, "_send_drafts", breaks)
    with pytest.raises(Exception, match="stopped after"):
        replay_by_rows(spark, str(tmp_path / "n"), topic, str(tmp_path / "ckpt"), "at", 10, first_tick)
    before = sent(topic)
    replay_by_rows(spark, str(tmp_path / "n"), topic, str(tmp_path / "ckpt"), "at", later_pace, later_tick)
    got = sent(topic)
    assert [m["k"] for ticks in got.values() for m in ticks] == list(range(101))
    assert list(got) == [f"batch={b:09d}" for b in range(len(got))]
    assert all([m["k"] for m in got[b]] == [m["k"] for m in before[b]] for b in before)  # begun ticks keep their pace
    assert all(len(ticks) == later_pace for b, ticks in list(got.items())[len(before):-1])


def test_an_empty_table_sends_nothing(spark, tmp_path):
    write_numbered(spark.createDataFrame([], "k long, at string"), ["k"], str(tmp_path / "n"))
    replay_by_rows(spark, str(tmp_path / "n"), str(tmp_path / "topic"), str(tmp_path / "ckpt"), "at", 10, "0 seconds")
    assert not os.path.exists(tmp_path / "topic")


def test_a_sample_stores_no_more_than_its_rows_of_a_partition(spark, monkeypatch):
    df = spark.range(0, 40_000, 1, 8).select((F.col("id") * 7919 % 40_009).alias("v"), "id")
    stored, kind = [], type(df)
    checkpoint = kind.checkpoint

    def counted(self, *args):
        stored.append(self.count())
        return checkpoint(self, *args)

    monkeypatch.setattr(kind, "checkpoint", counted)
    got = bounded_sample(df, 50, ("v", "id"))
    assert sorted(r["v"] for r in got.collect()) == sorted(i * 7919 % 40_009 for i in range(40_000))[:50]
    assert 50 <= stored[0] <= 8 * 50
