"""Rollups kept as partial states: sums, counts, extremes and the newest value of every key.

A state is computed from facts once and merged with others of its kind ever after, so an update reads the changed
facts and the stored states, never the facts before.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallyworks.functions import measures as m


@dataclass(frozen=True)
class State:
    """How a state comes from facts, and how stored states of one key become one."""

    start: Column
    again: Callable[[str], Column]


def counted(c: Column | str) -> State:
    """Non-null values of `c`."""
    return State(F.count(c), F.sum)


def true_counted(c: Column | str) -> State:
    return State(m.true_count(c), F.sum)


def money(c: Column | str) -> State:
    return State(m.money_sum(c), m.money_sum)


def least(c: Column | str) -> State:
    return State(F.min(c), F.min)


def greatest(c: Column | str) -> State:
    return State(F.max(c), F.max)


def newest(value: str, *order: str) -> State:
    """The value of the row with the highest `order` columns, kept beside them; ties fall to the greatest value.

    Rows without a first order column do not count.
    """
    held = F.when(F.col(order[0]).isNotNull(), F.struct(*order, F.col(value).alias("value")))
    return State(F.max(held), F.max)


@dataclass(frozen=True)
class Rollup:
    keys: Sequence[str]
    states: Mapping[str, State]
    where: Column | None = None  # facts that count

    def of(self, facts: DataFrame) -> DataFrame:
        """One row of states per key. Partial sums travel, so a hot key is one row per task."""
        kept = facts if self.where is None else facts.filter(self.where)
        return kept.groupBy(*self.keys).agg(*[s.start.alias(name) for name, s in self.states.items()])

    def merged(self, rows: DataFrame) -> DataFrame:
        """One row per key from any number of state rows, of the same type again."""
        kinds = dict(rows.dtypes)
        return rows.groupBy(*self.keys).agg(
            *[s.again(name).cast(kinds[name]).alias(name) for name, s in self.states.items()])
