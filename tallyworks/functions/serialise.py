"""Values as they leave for JSON consumers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def nan_to_null(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)


def _plain(field: T.StructField) -> Column:
    c = F.col(field.name)
    kind = field.dataType
    if isinstance(kind, T.DecimalType):
        return c.cast("double").alias(field.name)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return nan_to_null(c).alias(field.name)
    if isinstance(kind, T.DateType):
        return c.cast("string").alias(field.name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        micros = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return F.when(F.date_format(c, "SSSSSS") == "000000", whole).otherwise(micros).alias(field.name)
    return c


def plain_values(df: DataFrame) -> DataFrame:
    """Decimals as doubles, NaN as null, dates and timestamps as ISO text; other columns untouched."""
    return df.select(*[_plain(field) for field in df.schema.fields])


def as_message(*columns: Column | str) -> Column:
    """One JSON text per row. Null fields are left out and read back as null."""
    return F.to_json(F.struct(*columns)).alias("value")


def text_or_empty(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(""))


def title_prefix(c: Column | str, length: int = 50) -> Column:
    """The shortened title of a report line; the full title stays in its own column."""
    return F.substring(c, 1, length)
