"""Database reads, split into parallel ranges of a numeric, date or timestamp key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    bounds: tuple,
    partitions: int = 64,
    fetch_size: int = 10_000,
    **properties: str,
) -> DataFrame:
    """`table` is a table name or a parenthesised query with an alias.

    `bounds` only shapes the ranges; rows outside them still arrive in the first or last range. The
    database driver jar has to be on the class path of the session.
    """
    low, high = bounds
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", key)
        .option("lowerBound", str(low))
        .option("upperBound", str(high))
        .option("numPartitions", str(partitions))
        .option("fetchsize", str(fetch_size))
        .options(**properties)
        .load()
    )
