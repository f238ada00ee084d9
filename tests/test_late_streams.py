"""Streams out of order: late rows set aside, minutes that close, the newest rows per key."""

import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import states as st
from tallyworks.sinks import folding, snapshots
from tallyworks.streaming import closed_minutes as cm, lateness, newest, rollups

EVENT = "id int, day timestamp_ntz"


def counts():
    return st.Rollup(["date"], {"rows": st.counted("id")}, where=F.col("date").isNotNull())


def stream_days(spark, tmp_path, ids_and_days, delay=2):
    """One more batch of events (id, day of January, hour), then (rows per day, late ids)."""
    rows = [(i, datetime(2024, 1, d, h) if d else None) for i, d, h in ids_and_days]
    spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    lateness.stream_timely_rollup(
        source.withColumn("date", F.to_date("day")), counts(), str(tmp_path / "t"), str(tmp_path / "late"), str(tmp_path / "ckpt"),
        "day", timedelta(days=1), timedelta(days=delay)).awaitTermination()
    counted = {r["date"].day: r["rows"] for r in rollups.read_rollup(spark, str(tmp_path / "t"), counts()).collect()}
    late = spark.read.parquet(str(tmp_path / "late"))
    return counted, sorted(r["id"] for r in late.collect())


def test_rows_of_closed_days_are_set_aside_and_counted(spark, tmp_path):
    assert stream_days(spark, tmp_path, [(1, 10, 0), (2, 1, 5), (3, None, 0)]) == ({10: 1, 1: 1}, [])
    # 10 January 00:00 was seen: days that end by 8 January 00:00 are closed, so the 7th is the last closed one.
    assert stream_days(spark, tmp_path, [(4, 7, 23), (5, 8, 0), (6, 20, 0)]) == ({1: 1, 8: 1, 10: 1, 20: 1}, [4])
    assert stream_days(spark, tmp_path, [(7, 8, 0), (8, 17, 23), (9, 18, 0)]) == ({1: 1, 8: 1, 10: 1, 18: 1, 20: 1}, [4, 7, 8])


def test_a_batch_that_is_run_again_is_split_in_the_same_way(spark, tmp_path):
    path = str(tmp_path / "t")
    at = F.col("day")

    def days(*d):
        return spark.createDataFrame([(k, datetime(2024, 1, k)) for k in d], EVENT)

    assert lateness.note_seen(days(5, 9), at, path, 1, 0) == (datetime.min, datetime(2024, 1, 9))
    for _ in range(2):
        assert lateness.note_seen(days(20), at, path, 1, 1) == (datetime(2024, 1, 9), datetime(2024, 1, 20))
    assert lateness.note_seen(days(3), at, path, 2, 0) == (datetime(2024, 1, 20), datetime(2024, 1, 20))
    assert lateness.note_seen(spark.createDataFrame([], EVENT), at, path, 2, 1)[1] == datetime(2024, 1, 20)
    for batch in range(2, 40):
        lateness.note_seen(days(4), at, path, 2, batch)
    assert len(snapshots.small_files(spark, f"{path}/_seen")) <= 17


def test_newest_rows_of_a_key_do_not_depend_on_the_order_of_arrival(spark, tmp_path):
    rng, schema = random.Random(6), "k int, t int, id string, v int"
    rows = [(rng.choice([None, 1, 1, 1, 2, 3]), rng.choice([None, *range(9)]), f"i{rng.randrange(40)}", 0) for _ in range(300)]
    rows = [(k, t, i, hash((k, t, i)) % 5) for k, t, i, _ in rows]
    want = {}
    for k in {r[0] for r in rows}:
        own = sorted({r[1:] for r in rows if r[0] == k}, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
        want[k] = own[:4]
    for turn, parts in enumerate((1, 5)):
        rng.shuffle(rows)
        inbox = str(tmp_path / f"in{turn}")
        for p in range(parts):
            spark.createDataFrame(rows[p::parts], schema).coalesce(1).write.mode("append").parquet(inbox)
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(inbox)
        path = str(tmp_path / f"t{turn}")
        newest.stream_newest(source, path, str(tmp_path / f"c{turn}"), ["k"], "t", ["id"], 4, fold_every=2).awaitTermination()
        got = newest.read_newest(spark, path, ["k"], "t", ["id"], 4).collect()
        assert {k: sorted((tuple(r)[1:] for r in got if r["k"] == k), key=str) for k in want} == {
            k: sorted(w, key=str) for k, w in want.items()}
        # No folder holds more than the newest rows of each key.
        state = snapshots.latest(spark, path).state
        assert all(spark.read.parquet(f"{path}/{f}").count() <= 4 * len(want) for f in folding._folders(state))


def tweet(who, at, text=""):
    return json.dumps({"customer_id": who, "review_date": f"2024-05-01T{at}", "review_body": text})


def run_minutes(spark, tmp_path, name, lines):
    topic = tmp_path / "topic"
    topic.mkdir(exist_ok=True)
    (topic / name).write_text("\n".join(lines) + "\n")
    cm.stream_closed_minutes(spark.readStream.text(str(topic)), str(tmp_path / "m"), str(tmp_path / "ckpt")).awaitTermination()


def files(tmp_path):
    folder = tmp_path / "m" / "files"
    return {n: (folder / n).read_text() for n in os.listdir(folder) if n.endswith(".csv")} if folder.exists() else {}


HEAD = "author_id,created_at,text\n"
ONE = "tweets_01_05_2024_10_00.csv"
TWO = "tweets_01_05_2024_10_01.csv"


def test_a_minute_is_one_headed_file_once_it_is_over(spark, tmp_path):
    run_minutes(spark, tmp_path, "1", [tweet("b", "10:00:59", 'say "x", y'), tweet("a", "10:00:01"), tweet("c", "10:01:59")])
    assert files(tmp_path) == {}  # a minute later is 10:02, not seen yet
    run_minutes(spark, tmp_path, "2", [tweet("d", "10:00:30"), tweet("e", "10:02:00"), "{bad", tweet("x", "soon")])
    assert files(tmp_path) == {
        ONE: HEAD + 'a,2024-05-01T10:00:01,""\nd,2024-05-01T10:00:30,""\nb,2024-05-01T10:00:59,"say ""x"", y"\n'}
    run_minutes(spark, tmp_path, "3", [tweet("f", "10:00:10", "late"), tweet("g", "10:01:00")])
    cm.close_all(spark, str(tmp_path / "m"))
    assert sorted(files(tmp_path)) == [ONE, TWO, "tweets_01_05_2024_10_02.csv"]
    assert [r["author_id"] for r in cm.read_files(spark, str(tmp_path / "m")).where(F.col("minute_file") == TWO)
            .orderBy("created_at").collect()] == ["g", "c"]
    aside = spark.read.parquet(str(tmp_path / "m" / "quarantine")).collect()
    assert sorted((r["value"], r["reason"]) for r in aside) == sorted([
        ("{bad", "not JSON"), (tweet("x", "soon"), "unreadable time"),
        (json.dumps({"customer_id": "f", "review_date": "2024-05-01T10:00:10", "review_body": "late"}, separators=(",", ":")),
         cm.CLOSED)])


def test_a_failed_batch_is_done_again_without_loss_or_repeats(spark, tmp_path, monkeypatch):
    run_minutes(spark, tmp_path, "1", [tweet("a", "10:00:01"), tweet("b", "10:01:30")])
    real = cm.commit

    def fail(*_):
        raise OSError("the executor of the driver is gone")

    monkeypatch.setattr(cm, "commit", fail)
    with pytest.raises(Exception, match="driver is gone"):
        run_minutes(spark, tmp_path, "2", [tweet("c", "10:00:20"), tweet("d", "10:09:00")])
    assert set(files(tmp_path)) == {ONE, TWO}  # written, but the record has not moved
    monkeypatch.setattr(cm, "commit", real)
    run_minutes(spark, tmp_path, "3", [])
    cm.close_all(spark, str(tmp_path / "m"))
    got = sorted((r["author_id"], r["minute_file"]) for r in cm.read_files(spark, str(tmp_path / "m")).collect())
    assert got == [("a", ONE), ("b", TWO), ("c", ONE), ("d", "tweets_01_05_2024_10_09.csv")]
    assert not os.path.exists(tmp_path / "m" / "quarantine") or spark.read.parquet(str(tmp_path / "m" / "quarantine")).count() == 0
