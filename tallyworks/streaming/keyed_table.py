"""A keyed table fed by micro-batches.

Every micro-batch writes only its own rows, and a replayed batch counts once, so the cost of a batch does not grow with
the table. Every `fold_every` batches the folders are folded into a few sorted segments, so neither their number nor the cost
of reading grows with the age of the stream. Runs are numbered in the order in which their checkpoints first
appeared, so what arrives later counts, also under a new checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyworks.operators.keyed import newest_per_key
from tallyworks.sinks import folding
from tallyworks.sinks.folding import FoldingTable
from tallyworks.sinks.snapshots import create_once, read_small, small_files
from tallyworks.sinks.tables import write_clustered
from tallyworks.streaming import counts

RUN, BATCH = "run", "batch"
FOLD_EVERY = 16


def run_number(spark: SparkSession, path: str, checkpoint: str) -> int:
    """The run a checkpoint stands for: known ones keep their number, a new one gets the next.

    Batch numbers start again with a new checkpoint; the run number tells which came later. A run is a small file inside
    the table, named by its number and created in one step, so two streams that start together get two numbers.
    """
    name, registry = checkpoint.rstrip("/"), f"{path.rstrip('/')}/_runs"
    while True:
        known = {read_small(spark, f"{registry}/{f}"): int(f) for f in small_files(spark, registry)}
        if name in known:
            return known[name]
        number = max(known.values(), default=0) + 1
        if create_once(spark, f"{registry}/{number:09d}", name):
            return number


def keyed(path: str, keys: Sequence[str], order: Sequence[str] = (RUN, BATCH)) -> FoldingTable:
    """The table whose row of a key is the one with the highest `order` columns, then the latest arrival."""
    latest = [F.col(c).desc_nulls_last() for c in dict.fromkeys((*order, RUN, BATCH))]
    return FoldingTable(path.rstrip("/"), lambda rows: newest_per_key(rows, keys, latest), tuple(keys))


def append_batch(
    rows: DataFrame, path: str, run: int, batch: int, keys: Sequence[str], order: Sequence[Column]
) -> None:
    """Store the newest row per key of one batch; ties fall to the greatest other columns."""
    rest = [F.col(c).desc_nulls_last() for c in rows.columns if c not in keys]
    newest = newest_per_key(rows, keys, [*order, *rest])
    folding.append(_numbered(newest, run, batch), keyed(path, keys), run, batch)


def _numbered(rows: DataFrame, run: int, batch: int) -> DataFrame:
    return rows.withColumn(RUN, F.lit(run).cast("bigint")).withColumn(BATCH, F.lit(batch).cast("bigint"))


def stream_upsert(
    df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], checkpoint: str,
    mode: str = "append", split: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None,
    quarantine: str | None = None, fold_every: int | None = FOLD_EVERY,
    fold_order: Sequence[str] = (RUN, BATCH), count: bool = False, **trigger,
) -> StreamingQuery:
    """Start the upsert stream. Within a batch the row with the highest `order` columns stays.

    `split` may set rows aside (for example rows without a key), which go to `quarantine` in folders by
    run and batch. A fold keeps one row per key by `fold_order`, so readers that decide by other columns than arrival have
    to name them here as well; `fold_every=None` keeps all. With `count` the rows received, written and set aside are
    stored per batch (see `streaming.counts`). Pass `availableNow=True` or
    `processingTime="30 minutes"` as trigger.
    """
    spark = df.sparkSession
    run = run_number(spark, path, checkpoint)
    latest = [F.col(c).desc_nulls_last() for c in order]
    table = keyed(path, keys, fold_order)

    def write(batch_rows: DataFrame, batch: int) -> None:
        batch_rows, received = counts.observed(batch_rows, "received")
        kept = split is not None or count
        if kept:
            batch_rows = batch_rows.persist()
        good, bad = split(batch_rows) if split else (batch_rows, None)
        rest = [F.col(c).desc_nulls_last() for c in good.columns if c not in keys]
        newest, written = counts.observed(newest_per_key(good, keys, [*latest, *rest]), "written")
        before = folding.append(_numbered(newest, run, batch), table, run, batch)
        if quarantine and bad is not None:
            (
                _numbered(bad, run, batch)
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy(RUN, BATCH).parquet(quarantine)
            )
        # A batch that a segment holds already is not written again, and its counts stand.
        if count and any((t["run"], t["batch"]) == (run, batch) for t in before.state.get("tail", [])):
            counts.store_counts(spark, path, run, batch, received.get["rows"], written.get["rows"],
                                bad.count() if bad is not None else 0)
        if fold_every:
            folding.fold(spark, table, fold_every)
        if kept:
            batch_rows.unpersist()

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).foreachBatch(write).start()


def read_latest(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] = (RUN, BATCH)
) -> DataFrame:
    """The current rows. Filters on key columns reach the scan; `order` decides, highest first: by default arrival."""
    return folding.read(spark, keyed(path, keys, order)).drop(RUN, BATCH)


def compact(
    spark: SparkSession, path: str, out: str, keys: Sequence[str], sort_cols: Sequence[Column | str],
    order: Sequence[str] = (RUN, BATCH), part_cols: Sequence[str] = (),
) -> None:
    """Store the current rows, laid out for reading, at another path."""
    write_clustered(read_latest(spark, path, keys, order), out, part_cols, sort_cols)
