"""Late rows set aside and counted: what a batch may still change is decided before it is aggregated.

The greatest event time of the batches before, kept in a small file per batch, tells which windows are closed: those that end
`delay` or more before it. Rows of closed windows go to a table of late rows, all others are used. The file of a batch is
written once, so a batch that is run again is split in the same way.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyworks.operators.states import Rollup
from tallyworks.sinks import folding
from tallyworks.sinks.snapshots import create_once, read_small, remove, small_files
from tallyworks.streaming.keyed_table import BATCH, FOLD_EVERY, RUN, run_number
from tallyworks.streaming.rollups import rollup_table

_KEPT = 16


def seen_before(spark: SparkSession, path: str, run: int, batch: int) -> datetime:
    """The greatest event time of the batches of all runs that came before."""
    files = small_files(spark, f"{path}/_seen")
    earlier = [f for f in files if f < _name(run, batch)]
    return datetime.fromisoformat(read_small(spark, f"{path}/_seen/{earlier[-1]}")) if earlier else datetime.min


def _name(run: int, batch: int) -> str:
    return f"{run:09d}-{batch:012d}"


def note_seen(rows: DataFrame, time: Column, path: str, run: int, batch: int) -> tuple[datetime, datetime]:
    """(greatest event time before this batch, the same with this batch), which later batches will find."""
    spark = rows.sparkSession
    before = seen_before(spark, path, run, batch)
    newest = rows.agg(F.max(time.cast("timestamp_ntz"))).first()[0]
    after = max(before, newest or datetime.min)
    create_once(spark, f"{path}/_seen/{_name(run, batch)}", after.isoformat())
    # Only the batch that is running now can be run again, and it asks for the file before its own.
    remove(spark, [f"{path}/_seen/{f}" for f in small_files(spark, f"{path}/_seen")[:-_KEPT]])
    return before, after


def is_closed(window_end: Column, seen: datetime, delay: timedelta) -> Column:
    """Whether a window ends `delay` or more before what was seen. A null end is never closed."""
    if seen == datetime.min:
        return F.lit(False)
    last = F.lit((seen - delay).isoformat(sep=" ")).cast("timestamp_ntz")
    return F.coalesce(window_end.cast("timestamp_ntz") <= last, F.lit(False))


def store_late(late: DataFrame, path: str, run: int, batch: int) -> None:
    """The late rows of one batch in a folder of their own, which a replay replaces; without any, an empty one."""
    late.write.mode("overwrite").parquet(f"{path}/{RUN}={run}/{BATCH}={batch}")


def stream_timely_rollup(
    facts: DataFrame, rollup: Rollup, path: str, late_path: str, checkpoint: str, time: str, window: timedelta,
    delay: timedelta, fold_every: int | None = FOLD_EVERY, **trigger,
) -> StreamingQuery:
    """Bring a rollup forward by the rows in time, and keep those that came too late at `late_path`.

    Windows of length `window` start at the epoch (a day: the calendar day in UTC). Rows without a time are left to the rollup.
    """
    spark = facts.sparkSession
    run = run_number(spark, path, checkpoint)
    table = rollup_table(path, rollup)
    seconds = int(window.total_seconds())

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        at = F.col(time).cast("timestamp_ntz")
        before, _ = note_seen(batch, at, path, run, number)
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        start = F.floor(F.timestamp_diff("SECOND", epoch, at) / seconds) * seconds
        closed = is_closed(F.timestamp_add("SECOND", (start + seconds).cast("long"), epoch), before, delay)
        folding.append(rollup.of(batch.filter(~closed)), table, run, number)
        store_late(batch.filter(closed), late_path, run, number)
        if fold_every:
            folding.fold(spark, table, fold_every)
        batch.unpersist()

    writer = facts.writeStream.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).foreachBatch(write).start()
