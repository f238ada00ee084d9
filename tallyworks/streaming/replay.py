"""Replaying stored rows as a live stream, stamped with the time of sending."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyworks.functions.calendar import now_or


def restamp(df: DataFrame, col: str, now: Column | None = None) -> DataFrame:
    """Replace `col` by the current time as ISO text in UTC, or by a fixed instant."""
    utc = F.to_utc_timestamp(now_or(now), F.current_timezone())
    text = F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    return df.withColumn(col, text)


def replay(
    spark: SparkSession, path: str, schema: T.StructType, time_col: str, file_format: str = "csv",
    files_per_trigger: int = 1, now: Column | None = None, **options,
) -> DataFrame:
    """Stream the files of a folder, a few per trigger, with `time_col` restamped.

    The pace is set by `files_per_trigger` and the trigger interval of the query that is started on it.
    """
    reader = spark.readStream.schema(schema).format(file_format).options(**options)
    return restamp(reader.option("maxFilesPerTrigger", files_per_trigger).load(path), time_col, now)
