"""Stored tables: reload, clustered layout, and refresh of the partitions a batch touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F


def replace_table(df: DataFrame, path: str) -> None:
    """Drop and reload. `df` must not read `path`."""
    df.write.mode("overwrite").parquet(path)


def write_clustered(
    df: DataFrame,
    path: str,
    part_cols: Sequence[str] = (),
    sort_cols: Sequence[Column | str] = (),
    partitions: int | None = None,
    mode: str = "overwrite",
) -> None:
    """Rows sorted by `sort_cols` inside folders of `part_cols`.

    Use folders for keys with few values (year, month, region). For keys with many values (users,
    products) leave `part_cols` empty and put the key first in `sort_cols`: files then hold disjoint key
    ranges and readers skip them by min/max. Range partitioning on folder and sort columns together
    spreads one huge folder over many tasks, and keeps a small one in a single file.
    """
    order = [*part_cols, *sort_cols]
    spread = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    writer = spread.sortWithinPartitions(*order).write.mode(mode)
    if part_cols:
        writer = writer.partitionBy(*part_cols)
    writer.parquet(path)


def refresh_partitions(
    df: DataFrame, path: str, part_cols: Sequence[str], sort_cols: Sequence[Column | str] = (),
    touched: DataFrame | None = None,
) -> None:
    """Replace exactly the folders `df` has rows for and leave all others.

    This is the upsert of a recomputed rollup: a rerun for today overwrites today's folder and can be
    repeated after a failure. `df` must not read `path`. `touched` names folders (by `part_cols`) that were recomputed;
    those that came back empty are removed. Without `sort_cols` rows are ranged on all columns, so a large folder
    is written by many tasks.
    """
    order = [*part_cols, *(sort_cols or [c for c in df.columns if c not in part_cols])]
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*part_cols)
        .parquet(path)
    )
    if touched is not None:
        _drop_empty(df, path, part_cols, touched)


def _drop_empty(df: DataFrame, path: str, part_cols: Sequence[str], touched: DataFrame) -> None:
    """Delete the touched folders that `df` has no row for; their number is that of the partitions of one batch."""
    filled = df.select(*[F.col(c).alias(f"_{c}") for c in part_cols]).distinct()
    wanted = touched.select(*part_cols).distinct()
    same = F.lit(True)
    for c in part_cols:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    jvm, context = df.sparkSession._jvm, df.sparkSession.sparkContext
    names = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for row in wanted.join(filled, same, "left_anti").toLocalIterator():
        parts = [names.getPartitionPathString(c, None if row[c] is None else str(row[c])) for c in part_cols]
        folder = jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *parts]))
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def counted(df: DataFrame, bad: Column | None = None, name: str = "written") -> tuple[DataFrame, Observation]:
    """The frame with a row count, and a count of `bad` rows, taken while it is written: no extra job.

    Read `observation.get` after the write.
    """
    observation = Observation(name)
    failed = F.count_if(bad) if bad is not None else F.lit(0).cast("bigint")
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), failed.alias("failed")), observation
