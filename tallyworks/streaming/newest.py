"""The newest rows of every key from a stream, in whatever order they come."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyworks.operators.keyed import newest_per_key
from tallyworks.sinks import folding
from tallyworks.sinks.folding import FoldingTable
from tallyworks.streaming.keyed_table import FOLD_EVERY, run_number


def newest_table(path: str, keys: Sequence[str], newest: str, ties: Sequence[str], n: int) -> FoldingTable:
    """A table of at most `n` rows per key: the highest `newest`, ties by `ties`; rows that agree in all of these are one.

    The newest of the newest of parts are the newest of all, so batches may be merged in any order.
    """
    order: list[Column] = [F.col(newest).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]]

    def merge(rows: DataFrame) -> DataFrame:
        rest = [F.col(c).asc_nulls_last() for c in rows.columns if c not in (*keys, newest, *ties)]
        once = newest_per_key(rows, [*keys, newest, *ties], rest or [F.lit(1)])
        return newest_per_key(once, keys, order, n)

    return FoldingTable(path.rstrip("/"), merge, tuple(keys))


def stream_newest(
    rows: DataFrame, path: str, checkpoint: str, keys: Sequence[str], newest: str, ties: Sequence[str], n: int = 10,
    fold_every: int | None = FOLD_EVERY, **trigger,
) -> StreamingQuery:
    """Keep the newest `n` rows of every key. A batch stores n rows of each key it touches, however many come."""
    spark = rows.sparkSession
    run = run_number(spark, path, checkpoint)
    table = newest_table(path, keys, newest, ties, n)

    def write(batch: DataFrame, number: int) -> None:
        folding.append(table.merge(batch), table, run, number)
        if fold_every:
            folding.fold(spark, table, fold_every)

    writer = rows.writeStream.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).foreachBatch(write).start()


def read_newest(
    spark: SparkSession, path: str, keys: Sequence[str], newest: str, ties: Sequence[str], n: int = 10
) -> DataFrame:
    return folding.read(spark, newest_table(path, keys, newest, ties, n))
