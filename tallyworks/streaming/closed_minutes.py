"""One headed CSV file per minute, written when the minute is over.

Rows of open minutes wait in a table. Once the greatest event time seen is `delay` past a minute's end, the minute is closed: its
rows are written as the one file `tweets_<day>_<month>_<year>_<hour>_<minute>.csv`, sorted. What comes for a closed
minute later goes to quarantine, as do unreadable messages. The table's record moves last, so a batch that
failed half-way is done again from the same rows and replaces its files by equal ones.

A minute is one file and so one task; minutes are spread over tasks. The driver renames one file per closed minute.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyworks.functions.parsing import wall_clock
from tallyworks.sinks.snapshots import Snapshot, commit, latest, new_folder, remove, replace_file, small_files
from tallyworks.streaming.keyed_table import run_number
from tallyworks.streaming.lateness import is_closed, store_late
from tallyworks.streaming.minutes import FILE_COLUMN, minute_quarantine, minute_rows

CLOSED = "closed minute"
_SCHEMA = f"author_id string, created_at string, text string, {FILE_COLUMN} string"


def _minute_end() -> Column:
    return F.date_trunc("MINUTE", wall_clock("created_at")).cast("timestamp_ntz") + F.expr("INTERVAL 1 MINUTE")


def _waiting(spark: SparkSession, path: str, state: dict) -> DataFrame:
    folder = state.get("waiting")
    return spark.read.schema(_SCHEMA).parquet(f"{path}/{folder}") if folder else spark.createDataFrame([], _SCHEMA)


def _write_files(rows: DataFrame, path: str) -> int:
    """Write the rows of closed minutes, one file each; returns the number of files."""
    spark, draft = rows.sparkSession, f"{path}/{new_folder('draft')}"
    order = [FILE_COLUMN, "created_at", "author_id", "text"]
    (
        rows.repartition(FILE_COLUMN).sortWithinPartitions(*order)
        .write.option("header", True).option("escape", '"').partitionBy(FILE_COLUMN).csv(draft)
    )
    minutes = [name for name in small_files(spark, draft) if name.startswith(f"{FILE_COLUMN}=")]
    for minute in minutes:
        part = next(f for f in small_files(spark, f"{draft}/{minute}") if f.endswith(".csv"))
        replace_file(spark, f"{draft}/{minute}/{part}", f"{path}/files/{minute.split('=', 1)[1]}")
    remove(spark, [draft])
    return len(minutes)


def _advance(spark: SparkSession, path: str, state: dict, rows: DataFrame, seen: datetime, delay: timedelta,
             done: dict) -> None:
    """Close what can be closed of `rows` (waiting ones and new ones), keep the rest waiting, and move the record."""
    closing = is_closed(_minute_end(), seen, delay)
    _write_files(rows.filter(closing), path)
    folder = new_folder("waiting")
    rows.filter(~closing).write.parquet(f"{path}/{folder}")
    after = {"waiting": folder, "seen": seen.isoformat(), "done": done, "retired": state.get("waiting")}

    def change(now: Snapshot) -> dict | None:
        return after if now.state == state else None

    if commit(spark, path, change).state.get("waiting") != folder:
        remove(spark, [f"{path}/{folder}"])
        raise RuntimeError(f"another stream writes to {path}")
    if state.get("retired"):
        remove(spark, [f"{path}/{state['retired']}"])


def stream_closed_minutes(
    messages: DataFrame, path: str, checkpoint: str, delay: timedelta = timedelta(minutes=1), now: Column | None = None,
    **trigger,
) -> StreamingQuery:
    """Minute files at `path`/files, what cannot have a place there at `path`/quarantine (value, reason)."""
    spark = messages.sparkSession
    run = run_number(spark, path, checkpoint)

    def write(batch: DataFrame, number: int) -> None:
        state = latest(spark, path).state
        if number <= state.get("done", {}).get(str(run), -1):
            return
        batch = batch.persist()
        seen = datetime.fromisoformat(state["seen"]) if state else datetime.min
        rows = minute_rows(batch, now)
        closed = is_closed(_minute_end(), seen, delay)
        late = rows.filter(closed).select(F.to_json(F.struct(
            F.col("author_id").alias("customer_id"), F.col("created_at").alias("review_date"),
            F.col("text").alias("review_body"))).alias("value"), F.lit(CLOSED).alias("reason"))
        store_late(minute_quarantine(batch).unionByName(late), f"{path}/quarantine", run, number)
        newest = rows.agg(F.max(wall_clock("created_at"))).first()[0]
        both = _waiting(spark, path, state).unionByName(rows.filter(~closed))
        _advance(spark, path, state, both, max(seen, newest or datetime.min), delay, {**state.get("done", {}), str(run): number})
        batch.unpersist()

    writer = messages.writeStream.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).foreachBatch(write).start()


def close_all(spark: SparkSession, path: str) -> None:
    """Close the minutes that are still open, at the end of a day or of a replay."""
    state = latest(spark, path).state
    if state:
        _advance(spark, path, state, _waiting(spark, path, state), datetime.max, timedelta(0), state["done"])


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """author_id, created_at, text and the name of the file of every row."""
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    stored = spark.read.schema("author_id string, created_at string, text string").option("header", True).option(
        "escape", '"').option("multiLine", True).csv(f"{path}/files")
    return stored.select(*[F.coalesce(c, F.lit("")).alias(c) for c in stored.columns], name.alias(FILE_COLUMN))
