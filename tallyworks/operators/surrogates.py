"""Surrogate keys: dense ids for a dictionary and the way from names to ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyworks.operators.ranking import number_rows


def lookup_dimension(
    df: DataFrame, col: str, id_col: str, val_col: str, collation: str | None = None
) -> DataFrame:
    """Distinct non-null values in binary order with ids 1, 2, 3, ...

    With a collation (such as `UNICODE_CI_AI`) spellings that compare equal share one entry, the
    smallest spelling. The default compares bytes.
    """
    values = df.select(F.col(col).alias(val_col)).filter(F.col(val_col).isNotNull())
    if collation is None:
        distinct = values.distinct()
    else:
        distinct = (
            values.groupBy(F.collate(val_col, collation).alias("_same"))
            .agg(F.min(val_col).alias(val_col))
            .select(val_col)
        )
    return number_rows(distinct, [val_col], id_col).select(id_col, val_col)


def attach_ids(
    facts: DataFrame, name_col: str, dim: DataFrame, dim_name: str, dim_id: str, how: str = "inner"
) -> DataFrame:
    """Replace a natural name by its surrogate id.

    A name that occurs more than once in the dimension keeps its last (highest) id. With the inner
    join facts without an entry are dropped, with "left" they keep a null id.
    """
    latest = dim.groupBy(F.col(dim_name).alias(name_col)).agg(F.max(dim_id).alias(dim_id))
    return facts.join(latest, name_col, how).drop(name_col)
