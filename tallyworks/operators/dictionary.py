"""A stored dictionary of names that keeps the ids it gave.

A load numbers only the names that are not in it yet, in binary order after the highest id so far, and adds them in one
step; ids stay dense and never change. Two loads at a time end up one after the other: the one that comes second looks for its
new names again. After several loads the parts are stored as one, sorted by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyworks.operators.ranking import number_rows
from tallyworks.sinks.snapshots import Snapshot, commit, latest, new_folder, remove
from tallyworks.sinks.tables import counted, write_clustered

NAME, ID = "name", "id"
_SCHEMA = f"{NAME} string, {ID} bigint"
MOST_PARTS = 8


def _scan(spark: SparkSession, path: str, state: dict) -> DataFrame:
    parts = state.get("parts", [])
    if not parts:
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).parquet(*[f"{path}/{p}" for p in parts])


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(name, id)."""
    return _scan(spark, path, latest(spark, path).state)


def grow(names: DataFrame, col: str, path: str) -> int:
    """Bring the distinct non-null values of `col` into the dictionary; returns how many were new."""
    spark = names.sparkSession
    wanted = names.select(F.col(col).cast("string").alias(NAME)).filter(F.col(NAME).isNotNull()).distinct()
    while True:
        before = latest(spark, path)
        highest = before.state.get("highest", 0)
        fresh = wanted.join(_scan(spark, path, before.state), NAME, "left_anti")
        numbered = number_rows(fresh, [NAME], "_position").select(
            NAME, (F.col("_position") + highest).cast("bigint").alias(ID))
        part = new_folder("part")
        seen_rows, seen = counted(numbered)
        seen_rows.write.parquet(f"{path}/{part}")
        new = seen.get["rows"]
        if not new:
            remove(spark, [f"{path}/{part}"])
            return 0

        def record(now: Snapshot) -> dict | None:
            if now.version != before.version:
                return None
            return {"highest": highest + new, "parts": [*before.state.get("parts", []), part],
                    "retired": before.state.get("retired", [])}

        after = commit(spark, path, record)
        if part in after.state.get("parts", []):
            if len(after.state["parts"]) > MOST_PARTS:
                _gather(spark, path)
            return new
        remove(spark, [f"{path}/{part}"])


def _gather(spark: SparkSession, path: str) -> None:
    """Store all parts as one. A load that comes between wins, and the next one gathers."""
    before = latest(spark, path)
    whole = new_folder("part")
    write_clustered(_scan(spark, path, before.state), f"{path}/{whole}", sort_cols=[NAME])
    outdated: list[str] = []

    def record(now: Snapshot) -> dict | None:
        if now.version != before.version:
            outdated[:] = [whole]
            return None
        outdated[:] = now.state.get("retired", [])
        return {**now.state, "parts": [whole], "retired": now.state["parts"]}

    commit(spark, path, record)
    remove(spark, [f"{path}/{p}" for p in outdated])
