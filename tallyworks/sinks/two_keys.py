"""One stored layout that serves look-ups by either of two keys.

Each key is cut into ranges of about equal numbers of rows, and the bits of the two range numbers are interleaved. Rows sorted by
that number lie in files that span few ranges of either key, so a filter on one of them skips most files by the minimum and maximum
in the file footers, without a second copy of the table. The bounds of the ranges come from a sample of `SAMPLE` rows,
which only moves rows between files and never changes what is read back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SAMPLE = 20_000
BITS = 6  # 64 ranges of each key


def range_bounds(df: DataFrame, keys: Sequence[str], bits: int = BITS, sample: int = SAMPLE) -> list[list]:
    """For each key at most 2^bits - 1 values that cut its non-null values into ranges of about equal size."""
    rows = df.count()
    part = df.select(*keys)
    if rows > sample:
        part = part.sample(sample / rows, seed=7)
    ranges, out = 1 << bits, []
    drawn = part.collect()  # about `sample` rows
    for key in keys:
        values = sorted(r[key] for r in drawn if r[key] is not None)
        out.append(sorted({values[len(values) * k // ranges] for k in range(1, ranges)}) if values else [])
    return out


def range_number(key: str, bounds: list) -> Column:
    """How many bounds a value reaches; 0 for null."""
    if not bounds:
        return F.lit(0)
    reached = F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col(key))
    return F.size(reached)  # no bound compares with a null


def interleaved(first: Column, second: Column, bits: int = BITS) -> Column:
    """One number of the bits of both, the first one's above the second's."""
    out = F.lit(0)
    for k in range(bits):
        out = out + F.shiftleft(F.shiftright(first, k).bitwiseAND(F.lit(1)), 2 * k + 1) \
            + F.shiftleft(F.shiftright(second, k).bitwiseAND(F.lit(1)), 2 * k)
    return out


def write_two_keys(df: DataFrame, path: str, first: str, second: str, files: int | None = None, bits: int = BITS) -> None:
    """Store `df`, sorted for filters on `first` and on `second` alike, in about `files` files.

    Ranged by the interleaved number and both keys, so a value that holds a third of all rows is split too.
    """
    bounds = range_bounds(df, (first, second), bits)
    number = interleaved(range_number(first, bounds[0]), range_number(second, bounds[1]), bits)
    order = ["_number", first, second]
    placed = df.withColumn("_number", number)
    spread = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    spread.sortWithinPartitions(*order).drop("_number").write.mode("overwrite").parquet(path)
