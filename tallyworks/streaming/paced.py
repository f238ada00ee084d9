"""Replay at a pace counted in rows: so many messages per tick, however the stored files are cut.

Rows are numbered once in the order of sending. A rate source ticks through the numbers, and every tick sends the rows
whose number is due; as the numbered table is sorted, that reads the row groups of these rows only. Ticks without a pause
between them are all due, so many of them are written at once; each still gets its own rows and its own folder, in order.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from threading import Event

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyworks.functions.serialise import as_message, plain_values
from tallyworks.operators.ranking import number_rows
from tallyworks.sinks.snapshots import create_once, read_small, small_files
from tallyworks.streaming.replay import restamp

# Ticks without a pause that are written at once, and their rows: a stopped run repeats no more than that.
TICKS_AT_ONCE, ROWS_AT_ONCE = 1_000, 2_000_000


def write_numbered(df: DataFrame, order: Sequence[Column | str], path: str) -> None:
    """`df` with `position` from 1 in a total order, stored in that order."""
    number_rows(df, order).write.mode("overwrite").parquet(path)


def replay_by_rows(
    spark: SparkSession, path: str, topic: str, checkpoint: str, time_col: str,
    rows_per_tick: int = 15, tick: str = "1 second", now: Column | None = None,
) -> None:
    """Send a numbered table as JSON messages, `rows_per_tick` a tick, with `time_col` restamped; returns after the last.

    Each tick is a folder `batch=N` of the topic, which a repeated tick replaces. A run that was stopped goes on where its
    checkpoint ends; ticks that it had begun keep the pace they began with.
    """
    table = spark.read.parquet(path)
    total, finished = table.count(), Event()

    def send(ticks: DataFrame, batch: int) -> None:
        due = ticks.agg(F.min("value").alias("first"), F.max("value").alias("last")).first()
        if due["first"] is None or due["first"] >= total:
            finished.set()
            return
        rows = min(due["last"] + 1, total) - due["first"]
        first_tick, pace = _begun(spark, f"{checkpoint}/ticks", batch, rows, rows_per_tick)
        number = F.floor((F.col("position") - 1 - due["first"]) / pace) + first_tick
        dated = plain_values(restamp(
            table.filter(F.col("position").between(due["first"] + 1, due["last"] + 1)), time_col, now))
        sent = dated.select(
            as_message(*[c for c in dated.columns if c != "position"]),
            F.format_string("%09d", number).alias("batch"), "position")
        drafts = f"{topic}/_drafts"
        (
            sent.orderBy("batch", "position").drop("position")
            .write.mode("overwrite").partitionBy("batch").text(drafts)
        )
        _send_drafts(spark, drafts, topic)

    source = spark.readStream.format("rate-micro-batch").option(
        "rowsPerBatch", rows_per_tick * _ticks_at_once(spark, rows_per_tick, tick)).load()
    query = (
        source.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint)
        .trigger(processingTime=tick).start()
    )
    try:
        while not finished.wait(0.1) and query.isActive:
            pass
        if not finished.is_set():
            query.awaitTermination()  # raises what ended it
    finally:
        query.stop()


def _ticks_at_once(spark: SparkSession, rows_per_tick: int, tick: str) -> int:
    """One where time passes between ticks."""
    if spark._jvm.org.apache.spark.sql.streaming.Trigger.ProcessingTime(tick).intervalMs() > 0:
        return 1
    return max(1, min(TICKS_AT_ONCE, ROWS_AT_ONCE // rows_per_tick))


def _begun(spark: SparkSession, records: str, batch: int, rows: int, rows_per_tick: int) -> tuple[int, int]:
    """The number of the first tick of a batch, and its pace; of a repeated batch those that it began with.

    Ticks are numbered on from the record of the batch before; where there is none, every batch so far was one tick.
    """
    known = small_files(spark, records)

    def record(of: int) -> dict | None:
        name = f"{of:09d}"
        return json.loads(read_small(spark, f"{records}/{name}")) if name in known else None

    again, before = record(batch), record(batch - 1)
    if again:
        return again["tick"], again["pace"]
    first = before["next"] if before else batch
    after = first + -(-rows // rows_per_tick)
    create_once(spark, f"{records}/{batch:09d}", json.dumps({"tick": first, "pace": rows_per_tick, "next": after}))
    for name in known:
        if int(name) < batch - 1:
            _files(spark, records).delete(_path(spark, records, name), True)
    return first, rows_per_tick


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path(*parts)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _send_drafts(spark: SparkSession, drafts: str, topic: str) -> None:
    """Move the written ticks into the topic, one after the other; each is seen whole or not at all."""
    files = _files(spark, topic)
    written = [found.getPath().getName() for found in files.listStatus(_path(spark, drafts))]
    for name in sorted((n for n in written if n.startswith("batch=")), key=lambda n: int(n.removeprefix("batch="))):
        files.delete(_path(spark, topic, name), True)
        if not files.rename(_path(spark, drafts, name), _path(spark, topic, name)):
            raise OSError(f"{name} could not be moved to {topic}")
    files.delete(_path(spark, drafts), True)
