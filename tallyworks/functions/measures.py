"""Counts, money sums and the ratio family.

Ratios are divided and rounded as decimals (half up) and only then turned into doubles, so the
rounding does not depend on the order in which partial sums arrive. The members differ in scale and in
what they give for an empty divisor; they are kept apart on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_COUNT = "decimal(15,0)"
MONEY = "decimal(22,2)"  # what Spark gives for a sum of decimal(12,2); wide enough for 10^20


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rows() -> Column:
    return F.count(F.lit(1))


def true_count(c: Column | str) -> Column:
    return F.count_if(_col(c))


def money_sum(c: Column | str) -> Column:
    return F.sum(_col(c)).cast(MONEY)


def money_or_zero(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0)).cast(MONEY)


def count_or_zero(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0)).cast("bigint")


def _ratio(top: Column, bottom: Column, scale: int) -> Column:
    return F.round(top / F.nullif(bottom, F.lit(0)), scale).cast("double")


def ctr_pct(clicks: Column | str, impressions: Column | str) -> Column:
    """Clicks per hundred impressions, 4 digits; null without impressions."""
    hundred = F.lit(100).cast("decimal(3,0)")
    return _ratio(hundred * _col(clicks).cast(_COUNT), _col(impressions).cast(_COUNT), 4)


def ctr_share(clicks: Column | str, impressions: Column | str) -> Column:
    """Clicks per impression, 4 digits; null without impressions."""
    return _ratio(_col(clicks).cast(_COUNT), _col(impressions).cast(_COUNT), 4)


def ctr_daily(clicks: Column | str, impressions: Column | str) -> Column:
    """Clicks per impression, 6 digits; zero without impressions."""
    share = _ratio(_col(clicks).cast(_COUNT), _col(impressions).cast(_COUNT), 6)
    return F.coalesce(share, F.lit(0.0))


def cost_per_click(cost: Column | str, clicks: Column | str) -> Column:
    return _ratio(_col(cost).cast(MONEY), _col(clicks).cast(_COUNT), 4)


def cost_per_mille(cost: Column | str, impressions: Column | str) -> Column:
    thousand = F.lit(1000).cast("decimal(4,0)")
    return _ratio(thousand * _col(cost).cast(MONEY), _col(impressions).cast(_COUNT), 4)


def pct_of(part: Column | str, whole: Column | str) -> Column:
    """A share in per cent with 2 digits; null when the whole is zero."""
    hundred = F.lit(100).cast("decimal(3,0)")
    return _ratio(hundred * _col(part).cast(MONEY), _col(whole).cast("decimal(18,2)"), 2)


def mean_rating(total: Column | str, n: Column | str) -> Column:
    """Average of integer ratings with 2 digits."""
    return _ratio(_col(total).cast(_COUNT), _col(n).cast(_COUNT), 2)
