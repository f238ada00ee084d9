"""Mean, minimum and maximum of a measure per label and variant, and the ratio of two variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyworks.functions import measures as m


def variant_speedup(
    df: DataFrame, label: str, variant: str, measure: str, baseline: str, candidate: str
) -> DataFrame:
    """One row per label; `speedup` is baseline mean over candidate mean, null when that is zero.

    `measure` is a decimal(12,2): means are rounded to 4 digits from exact sums. The two variants are
    named, so the pivot needs no pass to find them.
    """
    sums = (
        df.groupBy(label).pivot(variant, [baseline, candidate])
        .agg(
            F.sum(measure).alias("sum"), F.count(measure).alias("n"),
            F.min(measure).alias("min"), F.max(measure).alias("max"),
        )
    )

    def exact_mean(v: str):
        return F.col(f"{v}_sum").cast(m.MONEY) / F.nullif(F.col(f"{v}_n").cast("decimal(15,0)"), F.lit(0))

    shown = [
        column
        for v in (baseline, candidate)
        for column in (
            F.round(exact_mean(v), 4).cast("double").alias(f"{v}_mean"),
            F.col(f"{v}_min"),
            F.col(f"{v}_max"),
        )
    ]
    rounded = [F.round(exact_mean(v), 4).cast("decimal(18,4)") for v in (baseline, candidate)]
    ratio = F.round(rounded[0] / F.nullif(rounded[1], F.lit(0)), 2).cast("double")
    return sums.select(F.col(label), *shown, ratio.alias("speedup"))
