"""Report output: one headed CSV per report and a JSON manifest."""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyworks.sinks.tables import counted


def write_report_csv(df: DataFrame, path: str) -> None:
    """Headed CSV files in their own folder, in the order of the report; a small report is one file."""
    df.write.mode("overwrite").option("header", True).csv(path)


def _row_json(df: DataFrame):
    """A row as JSON text: dates in ISO form, decimals as strings, nulls kept."""
    columns = [
        F.col(f.name).cast("string").alias(f.name)
        if f.dataType.typeName().startswith(("decimal", "date", "timestamp")) else F.col(f.name)
        for f in df.schema.fields
    ]
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def report_rows(reports: Mapping[str, tuple[str, DataFrame]]) -> DataFrame:
    """(query, row_json): all rows of all reports."""
    rows = None
    for key, (_, df) in reports.items():
        one = df.select(F.lit(key).alias("query"), _row_json(df).alias("row_json"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


def run_report(
    spark: SparkSession,
    reports: Mapping[str, tuple[str, DataFrame]],
    start: date,
    end: date,
    out: str,
    generated_at: datetime | None = None,
) -> dict:
    """Write every report, the rows of all of them and `report.json`; `reports` maps a key to (title, frame).

    A report goes from Spark to `<key>.csv`, its rows as JSON lines to `rows/query=<key>`, whatever their number. The
    driver sees the row counts only.
    """
    stamp = (generated_at or datetime.now(timezone.utc)).replace(tzinfo=None)
    manifest = {
        "generated_at": stamp.isoformat() + "Z",
        "analysis_window": {"start": start.isoformat(), "end": end.isoformat()},
        "rows": f"{out}/rows",
        "queries": {},
    }
    for key, (title, df) in reports.items():
        csv_path = f"{out}/{key}.csv"
        df = df.persist()
        tracked, seen = counted(df, name=f"report_{key}")
        write_report_csv(tracked, csv_path)
        df.select(_row_json(df).alias("value")).write.mode("overwrite").text(f"{out}/rows/query={key}")
        df.unpersist()
        manifest["queries"][key] = {
            "title": title, "csv_file": csv_path, "rows_file": f"{out}/rows/query={key}", "columns": df.columns,
            "row_count": seen.get["rows"],
        }
    document = spark.createDataFrame([(json.dumps(manifest),)], "value string")
    document.coalesce(1).write.mode("overwrite").text(f"{out}/report.json")
    return manifest


def report_counts(reports: Mapping[str, tuple[str, DataFrame]]) -> DataFrame:
    """The manifest's row counts as a frame, computed in one job."""
    counts = None
    for key, (title, df) in reports.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(key).alias("query"), F.lit(title).alias("title"), "row_count"
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts
