"""Referential checks: orphans of a foreign key and cascading deletes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

# name, child frame, child column, parent frame, parent column
ForeignKey = tuple[str, DataFrame, str, DataFrame, str]


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Key values without a parent and the rows that carry them. A null key violates nothing.

    Rows are counted per key before the join: it then shuffles distinct keys, and a hot key is one row.
    """
    used = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("key"))
        .agg(F.count(F.lit(1)).alias("orphan_rows"))
    )
    known = parent.select(F.col(parent_key).alias("key"))
    return used.join(known, "key", "left_anti")


def orphan_report(keys: Sequence[ForeignKey]) -> DataFrame:
    """One row per foreign key: distinct orphan values and the rows that carry them.

    All keys of one child frame are counted in a single pass over it, and one anti join serves all
    foreign keys; values are compared as text. A key without orphans has a row of zeros.
    """
    by_child: dict[int, tuple[DataFrame, list]] = {}
    for name, child, child_key, _, _ in keys:
        pair = F.struct(F.lit(name).alias("foreign_key"), F.col(child_key).cast("string").alias("key"))
        by_child.setdefault(id(child), (child, []))[1].append(pair)
    used = reduce(DataFrame.unionByName, [
        child.select(F.inline(F.array(*pairs))).filter(F.col("key").isNotNull())
        .groupBy("foreign_key", "key").agg(F.count(F.lit(1)).alias("rows"))
        for child, pairs in by_child.values()
    ])
    known = reduce(DataFrame.unionByName, [
        parent.select(F.lit(name).alias("foreign_key"), F.col(parent_key).cast("string").alias("key"))
        for name, _, _, parent, parent_key in keys
    ])
    found = (
        used.join(known, ["foreign_key", "key"], "left_anti")
        .groupBy("foreign_key")
        .agg(F.count(F.lit(1)).alias("orphan_keys"), F.sum("rows").alias("orphan_rows"))
    )
    names = F.explode(F.array(*[F.lit(key[0]) for key in keys])).alias("foreign_key")
    every = keys[0][1].sparkSession.range(1).select(names)
    return every.join(found, "foreign_key", "left").fillna(0)


def cascade(junction: DataFrame, parents: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """The junction rows that survive when only the given parents remain; `(column, parent)` pairs."""
    for key, parent in parents:
        junction = junction.join(parent.select(key), key, "left_semi")
    return junction
