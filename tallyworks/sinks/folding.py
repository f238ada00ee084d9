"""A table fed in batches that folds its own folders.

Every batch is a folder of its own in the tail. A fold merges the tail, and those segments that are not much larger than
what is merged, into one new segment; so a row is rewritten a number of times that grows with the logarithm of the table,
and the number of folders stays as small. What counts is the table's newest record: a reader takes it once and
sees the state before a fold or the one after, and a fold that another writer overtook is thrown away.

How rows of one key become one row is up to the table: the newest row for keyed tables, summed partial states for
rollups. The merge must not depend on how rows are split: merge(merge(a) + b) = merge(a + b).

A batch counts once. A replayed batch replaces its folder, or is left out when a segment holds it already.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from tallyworks.sinks.snapshots import Snapshot, commit, latest, new_folder, remove
from tallyworks.sinks.tables import counted, write_clustered

Merge = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class FoldingTable:
    path: str
    merge: Merge
    sort_cols: Sequence[str]


def _folders(state: dict) -> list[str]:
    return [s["folder"] for s in state.get("segments", [])] + [t["folder"] for t in state.get("tail", [])]


def _is_folded(state: dict, run: int, batch: int) -> bool:
    return batch <= state.get("folded", {}).get(str(run), -1)


def _scan(spark: SparkSession, path: str, state: dict, folders: Sequence[str]) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(state["schema"]))
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in folders])


def append(rows: DataFrame, table: FoldingTable, run: int, batch: int) -> Snapshot:
    """Add the rows of one batch, which must come merged (one row per key)."""
    spark, path = rows.sparkSession, table.path
    known = latest(spark, path)
    if _is_folded(known.state, run, batch):
        return known
    folder = new_folder(f"tail-{run}-{batch}")
    rows.write.parquet(f"{path}/{folder}")
    replaced: list[str] = []

    def change(before: Snapshot) -> dict | None:
        replaced.clear()
        if _is_folded(before.state, run, batch):
            replaced.append(folder)
            return None
        tail = before.state.get("tail", [])
        replaced.extend(t["folder"] for t in tail if (t["run"], t["batch"]) == (run, batch))
        stay = [t for t in tail if (t["run"], t["batch"]) != (run, batch)]
        return {**before.state, "schema": rows.schema.json(),
                "tail": [*stay, {"run": run, "batch": batch, "folder": folder}]}

    after = commit(spark, path, change)
    remove(spark, [f"{path}/{f}" for f in replaced])
    return after


def read(spark: SparkSession, table: FoldingTable) -> DataFrame:
    """The merged rows of the newest record. Filters on the key columns reach the scan."""
    state = latest(spark, table.path).state
    if not state:
        raise FileNotFoundError(f"no table at {table.path}")
    return table.merge(_scan(spark, table.path, state, _folders(state)))


def fold(spark: SparkSession, table: FoldingTable, least: int = 1) -> Snapshot:
    """Merge the tail into a segment, once it holds `least` folders."""
    path = table.path
    before = latest(spark, path)
    tail = before.state.get("tail", [])
    if len(tail) < max(least, 1):
        return before
    taken = [t["folder"] for t in tail]
    size = _scan(spark, path, before.state, taken).count()  # from the footers of the files
    for segment in reversed(before.state.get("segments", [])):
        if segment["rows"] > 2 * size:
            break
        taken.append(segment["folder"])
        size += segment["rows"]
    folder = new_folder("segment")
    merged, seen = counted(table.merge(_scan(spark, path, before.state, taken)))
    write_clustered(merged, f"{path}/{folder}", sort_cols=table.sort_cols)
    done = dict(before.state.get("folded", {}))
    for t in tail:
        done[str(t["run"])] = max(done.get(str(t["run"]), -1), t["batch"])
    outdated: list[str] = []

    def change(now: Snapshot) -> dict | None:
        outdated.clear()
        if not set(taken) <= set(_folders(now.state)):  # another fold, or a replay of a batch, came first
            outdated.append(folder)
            return None
        outdated.extend(now.state.get("retired", []))
        return {
            "schema": now.state["schema"], "folded": done, "retired": taken,
            "segments": [*(s for s in now.state.get("segments", []) if s["folder"] not in taken),
                         {"folder": folder, "rows": seen.get["rows"]}],
            "tail": [t for t in now.state["tail"] if t["folder"] not in taken],
        }

    after = commit(spark, path, change)
    remove(spark, [f"{path}/{f}" for f in outdated])
    return after
