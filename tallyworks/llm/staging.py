"""Intermediate tables in the folder that all executors share, and this package on the executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

from tallyworks.session import scratch_path


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; the name only helps a reader of the listing."""
    return scratch_path(spark, name)


def staged(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """`df` written once as Parquet and read again: its lineage ends there, and a lost executor costs a re-read."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver was started."""
    context = spark.sparkContext
    if getattr(context, "_tallyworks_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tallyworks-"), f"tallyworks-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
    context._tallyworks_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
