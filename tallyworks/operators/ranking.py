"""Global positions, ranks inside groups and top-N without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyworks.session import enable_checkpoints

# monotonically_increasing_id() documents its layout: partition number above 33 bits of row number.
_ROW_BITS = 33


def number_rows(
    df: DataFrame, order: Sequence[Column | str], name: str = "position", first: int | None = None
) -> DataFrame:
    """Exact consecutive numbers from 1 in the given total order.

    A range-partitioned sort spreads the rows by the whole order, so ties and hot values are split
    between tasks. The sorted rows are checkpointed, which fixes their placement for any retry; then
    one count per sorted partition gives the offset to add. The offsets have one row per shuffle
    partition: that bounds both their broadcast and the running sum over them.

    With `first` only rows that may be among the first so many are stored: no more than that of each partition.
    Numbers up to `first` are exact; later ones are cut off.
    """
    enable_checkpoints(df.sparkSession)
    slot = F.monotonically_increasing_id()
    in_part = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    placed = df.orderBy(*order).withColumn("_slot", slot)
    placed = (placed if first is None else placed.filter(in_part < first)).checkpoint()
    part = F.shiftright("_slot", _ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    numbered = (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, (in_part + F.col("_offset") + 1).cast("bigint"))
        .drop("_slot", "_part", "_offset")
    )
    return numbered if first is None else numbered.filter(F.col(name) <= first)


def rank_within(
    df: DataFrame, by: Sequence[str], order: Sequence[Column | str], name: str = "rank"
) -> DataFrame:
    """Row number inside each group of `by`, exact however large one group is.

    Rows get their global position first; subtracting the first position of the group leaves the rank,
    so no task has to hold a group. Spark broadcasts the starts of few groups by their size and shuffles those of
    many, where AQE splits hot keys.
    """
    if not by:
        return number_rows(df, order, name)
    placed = number_rows(df, [*by, *order], "_position")
    starts = placed.groupBy(*[F.col(c).alias(f"_by_{c}") for c in by]).agg(F.min("_position").alias("_first"))
    same = F.lit(True)
    for c in by:
        same = same & placed[c].eqNullSafe(starts[f"_by_{c}"])
    ranked = placed.join(starts, same).withColumn(name, F.col("_position") - F.col("_first") + 1)
    return ranked.select(*df.columns, name)


def top_n(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first `n` rows of a report in a total order; every task keeps n rows, one merges them."""
    return df.orderBy(*order).limit(n)
