"""Keyed-table semantics on DataFrames: newest rows per key, insert-ignore and upsert.

All three rest on `row_number() <= n`, for which Spark keeps only n rows per key in every map task before
the shuffle. A key that holds a third of all rows therefore sends n rows per task and not its whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_SIDE = "_incoming"
_LAST = (1 << 63) - 1  # in place of no date; no date is as far back


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first `n` rows of every key under `order`, which should be total."""
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", ranked).filter(F.col("_rn") <= n).drop("_rn")


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key where rows of a key are meant to be copies; should they differ, the greatest stays."""
    rest = [F.col(c).desc_nulls_last() for c in df.columns if c not in keys]
    return newest_per_key(df, keys, rest or [F.col(c) for c in keys])


def one_per_key_sorted(df: DataFrame, keys: Sequence[str], descending: Sequence[str] = ()) -> DataFrame:
    """`one_per_key` in the global order of `keys`, those of `descending` from high to low with nulls last.

    The rows are shuffled once, ranged by all keys: a busy first key is spread over many tasks, and copies meet in the task
    that sorts them. A descending date travels as days counted backwards, so that the sort that finds the copies is the
    final one, too.
    """
    dates = [c for c in descending if dict(df.dtypes)[c] == "date"]
    days = {c: F.coalesce(-F.unix_date(c).cast("bigint"), F.lit(_LAST).cast("bigint")).alias(f"_back_{c}") for c in dates}
    again = {c: F.date_from_unix_date((-F.col(f"_back_{c}")).try_cast("int")).alias(c) for c in dates}  # of _LAST: null
    names = [f"_back_{c}" if c in days else c for c in keys]
    order = [F.desc(c) if c in descending else F.col(c) for c in names]
    ranged = df.select(*[days.get(c, c) for c in df.columns]).repartitionByRange(*order)
    return one_per_key(ranged, names).orderBy(*order).select(*[again.get(c, c) for c in df.columns])


def insert_ignore(
    target: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """`target` plus the rows of `new` whose key it lacks; the first row by `order` wins within `new`."""
    first = newest_per_key(new, keys, order)
    known = target.select(*[F.col(key).alias(f"_known_{key}") for key in keys])
    same_key = F.lit(True)
    for key in keys:
        same_key = same_key & F.col(key).eqNullSafe(F.col(f"_known_{key}"))
    fresh = first.join(known, same_key, "left_anti")
    return target.unionByName(fresh)


def upsert(
    target: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per key, the one with the highest `order` columns; on a tie the row of `new` wins.

    Deciding by a column and not by arrival makes the result independent of retries and of the order in
    which batches come in.
    """
    both = target.withColumn(_SIDE, F.lit(0)).unionByName(new.withColumn(_SIDE, F.lit(1)))
    latest = [F.col(c).desc_nulls_last() for c in (*order, _SIDE)]
    rest = [c for c in target.columns if c not in keys and c not in order]
    return newest_per_key(both, keys, latest + [F.col(c).desc_nulls_last() for c in rest]).drop(_SIDE)
