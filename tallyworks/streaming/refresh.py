"""Periodic recomputation of rollups."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from tallyworks.sinks.tables import refresh_partitions


def stream_refresh(
    arrivals: DataFrame, recompute: Callable[[DataFrame], DataFrame], table: str, checkpoint: str,
    part_cols: Sequence[str], sort_cols: Sequence[Column | str] = (), every: str | None = "30 minutes",
    touched: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """After each trigger with new rows, recompute the touched partitions of `table` and replace them.

    `recompute` gets the arrived rows and returns the full new content of every partition they touch,
    usually from the stored events of those days. Replacing whole partitions makes a replay harmless.
    `touched` gives the partitions a batch touches, so that those without any content left are removed.
    `every=None` handles what is there now and stops.
    """
    trigger = {"availableNow": True} if every is None else {"processingTime": every}

    def write(batch: DataFrame, _: int) -> None:
        refresh_partitions(recompute(batch), table, part_cols, sort_cols, touched(batch) if touched else None)

    return (
        arrivals.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**trigger).foreachBatch(write).start()
    )
