"""What a stream wrote and what it had to leave out, per batch.

The counts are taken while the rows are written (`observe`), so they cost no pass of their own, and are stored with the number of
the batch: a batch that is run again replaces its counts. The table folds like the one it belongs to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tallyworks.operators.keyed import newest_per_key
from tallyworks.sinks import folding
from tallyworks.sinks.folding import FoldingTable

SCHEMA = "run bigint, batch bigint, received bigint, written bigint, failed bigint"
FOLD_EVERY = 64


def counts_table(path: str) -> FoldingTable:
    return FoldingTable(f"{path.rstrip('/')}_counts", lambda rows: newest_per_key(rows, ["run", "batch"], [F.desc("received")]),
                        ("run", "batch"))


def observed(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The rows, counted by whatever action runs over them first."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def store_counts(spark: SparkSession, path: str, run: int, batch: int, received: int, written: int, failed: int) -> None:
    table = counts_table(path)
    one = spark.createDataFrame([(run, batch, received, written, failed)], SCHEMA).coalesce(1)
    folding.append(one, table, run, batch)
    folding.fold(spark, table, FOLD_EVERY)


def write_counts(spark: SparkSession, path: str) -> DataFrame:
    """(run, batch, received, written, failed) of the table at `path`.

    Received rows are written, or failed and set aside, or give way to another row of their key in the batch.
    """
    return folding.read(spark, counts_table(path))
