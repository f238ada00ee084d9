"""File scans. Raw files are read as text columns with a given schema: no inference pass over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyworks import schemas


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Headed CSV of any size; Spark splits it, so there is no chunk loop.

    Columns are matched by header name, so files may hold more columns or another order. Files of one folder must
    agree in their header; one that differs fails the read instead of swapping columns. `multi_line` accepts
    quoted line breaks, at the price of files that are not split.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("enforceSchema", False)
    raw = reader.option("multiLine", multi_line).csv(path)
    present = {name.lower(): name for name in raw.columns}
    return raw.select(*[
        (F.col(f"`{present[field.name.lower()]}`") if field.name.lower() in present else F.lit(None))
        .cast(field.dataType).alias(field.name)
        for field in schema.fields
    ])


def read_ad_events(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.AD_EVENTS_RAW)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.USERS_RAW)


def read_campaigns(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.CAMPAIGNS_RAW)


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.REVIEWS_RAW)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table or rollup."""
    return spark.read.parquet(path)


def read_keyed(spark: SparkSession, path: str, **keys) -> DataFrame:
    """The rows of one key of a clustered table.

    A key that is a folder column prunes folders; any other skips row groups by their min/max. A null key finds the
    rows stored without one.
    """
    df = spark.read.parquet(path)
    for name, value in keys.items():
        df = df.filter(F.col(name).eqNullSafe(F.lit(value)))
    return df
