"""Month ranges from running totals: any range is a difference of two rows per key.

A row says how many reviews a key had in all months up to `from_month`; it holds until the key's next month with reviews.
The rows that hold in one month are one per key. Stored in folders of `from_month` and sorted by `until_month`, those of
a month are found by folder names and row-group min/max, so the months of a long range are never scanned one by one.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyworks.functions.calendar import parse_date_range
from tallyworks.operators.ranking import top_n
from tallyworks.sinks.tables import write_clustered

ALWAYS = (1 << 31) - 1  # until_month of a row that still holds


def _month(day: date) -> int:
    return day.year * 12 + day.month


def running_totals(monthly: DataFrame, key: str, title: str | None = None) -> DataFrame:
    """(key, from_month, until_month, total, title) from monthly counts with year, month and review_count.

    The title is that of the row's own month: of several the one with the fewest reviews, of those the greatest. Months
    are numbered year * 12 + month; rows without one are left out. A key has a row per month, so its window is short; a
    null key is a key of its own.
    """
    shown = [F.max_by(title, F.struct(-F.col("review_count"), title)).alias(title)] if title else []
    own = (
        monthly.withColumn("from_month", (F.col("year") * 12 + F.col("month")).cast("int"))
        .filter(F.col("from_month").isNotNull())
        .groupBy(key, "from_month").agg(F.sum("review_count").alias("_own"), *shown)
    )
    months = Window.partitionBy(key).orderBy("from_month")
    return own.select(
        key, "from_month",
        F.coalesce(F.lead("from_month").over(months), F.lit(ALWAYS)).alias("until_month"),
        F.sum("_own").over(months.rowsBetween(Window.unboundedPreceding, 0)).alias("total"),
        *([title] if title else []),
    )


def write_running_totals(totals: DataFrame, path: str, key: str) -> None:
    write_clustered(totals, path, ["from_month"], ["until_month", key])


def _holds_in(month: int) -> Column:
    """Bare comparisons, so that folders and row groups are skipped."""
    return (F.col("from_month") <= month) & (F.col("until_month") > month)


def range_counts(
    totals: DataFrame, key: str, start: str | date, end: str | date, name: str = "review_count",
    title: str | None = None,
) -> DataFrame:
    """Reviews per key in the months touched by the range, for keys that have any; the title is that of the latest one."""
    first, last = parse_date_range(start, end)
    none = [F.lit(None).cast("string").alias(title)] if title else []
    at_end = totals.filter(_holds_in(_month(last))).select(key, "total", *([title] if title else []))
    before = totals.filter(_holds_in(_month(first) - 1)).select(key, (-F.col("total")).alias("total"), *none)
    shown = [F.max(title).alias(title)] if title else []
    both = at_end.unionByName(before).groupBy(key).agg(*shown, F.sum("total").alias(name))
    return both.filter(F.col(name) > 0)


def most_reviewed(totals: DataFrame, start: str | date, end: str | date, n: int = 10) -> DataFrame:
    """Top `n` products over the months touched by the range, as the plan of that name gives them."""
    if not 1 <= n <= 500:
        raise ValueError("n must be between 1 and 500")
    counts = range_counts(totals, "product_id", start, end, title="product_title")
    return top_n(counts, [F.desc("review_count"), "product_id"], n)


def most_reviewed_in(totals: DataFrame, ranges: Sequence[tuple[date, date]], n: int = 10) -> DataFrame:
    """`most_reviewed` of several ranges, with the range as a column."""
    rows = None
    for start, end in ranges:
        one = most_reviewed(totals, start, end, n).select(
            F.lit(f"{start} to {end}").alias("months"), "product_id", "product_title", "review_count")
        rows = one if rows is None else rows.unionByName(one)
    return rows
