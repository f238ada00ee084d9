"""The bounded sample: the first N rows under a stated order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tallyworks.operators.ranking import number_rows


def bounded_sample(df: DataFrame, n: int = 100_000, order_cols: Sequence[str] = ("event_id",)) -> DataFrame:
    """Exactly the first `n` rows by `order_cols` (which should be total), or all rows when there are fewer.

    Rows are sorted by ranges and numbered from one count per sorted partition, for every n and column type alike. No
    task sees more than its range, stores more than n rows of it, and partitions beyond the cut give nothing. Nulls come
    first.
    """
    return number_rows(df, order_cols, "_position", first=n).drop("_position")
