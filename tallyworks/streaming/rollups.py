"""Rollups that a stream brings forward by the states of each batch, without reading earlier facts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyworks.operators.states import Rollup
from tallyworks.sinks import folding
from tallyworks.sinks.folding import FoldingTable
from tallyworks.streaming.keyed_table import FOLD_EVERY, run_number


def rollup_table(path: str, rollup: Rollup) -> FoldingTable:
    return FoldingTable(path.rstrip("/"), rollup.merged, tuple(rollup.keys))


def stream_rollup(
    facts: DataFrame, rollup: Rollup, path: str, checkpoint: str, fold_every: int | None = FOLD_EVERY,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch, **trigger,
) -> StreamingQuery:
    """Add the states of every batch of `facts` to the stored rollup. A batch counts once, however often it is run.

    `prepare` may join or filter a batch. There is no watermark: a late row changes its key like any other.
    """
    spark = facts.sparkSession
    run = run_number(spark, path, checkpoint)
    table = rollup_table(path, rollup)

    def write(batch: DataFrame, number: int) -> None:
        folding.append(rollup.of(prepare(batch)), table, run, number)
        if fold_every:
            folding.fold(spark, table, fold_every)

    writer = facts.writeStream.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).foreachBatch(write).start()


def read_rollup(spark: SparkSession, path: str, rollup: Rollup) -> DataFrame:
    """The states of every key as of the newest record."""
    return folding.read(spark, rollup_table(path, rollup))
