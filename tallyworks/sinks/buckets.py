"""A stored table in buckets of its key: an upsert reads and replaces only the buckets that its changes touch.

A row's bucket is a hash of its key. Each bucket is one folder, and the table's record names the folder of every
bucket; a change writes new folders for the touched buckets and puts the record in place last, so readers see all of it or
nothing. Keys are unique, so buckets are even; a key with many changes is cut to its winning row in the map
tasks, before anything is shuffled. A look-up by key reads one bucket.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyworks.operators.keyed import insert_ignore, newest_per_key, upsert
from tallyworks.session import scratch_path
from tallyworks.sinks.snapshots import Snapshot, commit, latest, new_folder, remove

BUCKETS = 64
_BUCKET = "_bucket"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _scan(spark: SparkSession, path: str, state: dict, buckets: Sequence[int] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(state["schema"]))
    wanted = state["folders"].values() if buckets is None else [
        state["folders"][str(b)] for b in buckets if str(b) in state["folders"]]
    if not wanted:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in wanted])


def _change(
    new: DataFrame, path: str, keys: Sequence[str], buckets: int, order: Sequence[Column],
    combine: Callable[[DataFrame, DataFrame], DataFrame],
) -> list[int]:
    spark = new.sparkSession
    empty = {"schema": new.schema.json(), "buckets": buckets, "folders": {}}
    size = commit(spark, path, lambda now: None if now.state else empty).state["buckets"]
    routed = newest_per_key(new, keys, order).withColumn(_BUCKET, _bucket(keys, size))
    staged = scratch_path(spark, "changes")
    routed.write.parquet(staged)
    changes = spark.read.schema(routed.schema).parquet(staged)
    touched = sorted(r[0] for r in changes.select(_BUCKET).distinct().collect())  # at most one number per bucket
    if not touched:
        return touched

    written: list[str] = []
    while True:
        base = latest(spark, path).state
        after = combine(_scan(spark, path, base, touched), changes.drop(_BUCKET))
        version = new_folder("version")
        (
            after.withColumn(_BUCKET, _bucket(keys, size))
            .repartition(len(touched), _BUCKET).sortWithinPartitions(_BUCKET, *keys)
            .write.partitionBy(_BUCKET).parquet(f"{path}/{version}")
        )
        written.append(version)
        outdated: list[str] = []

        def record(now: Snapshot) -> dict | None:
            folders = now.state["folders"]
            if any(folders.get(str(b)) != base["folders"].get(str(b)) for b in touched):
                return None  # another change of these buckets came first: merge with what it left
            outdated[:] = now.state.get("retired", [])
            replaced = [folders[str(b)] for b in touched if str(b) in folders]
            return {**base, "folders": {**folders, **{str(b): f"{version}/{_BUCKET}={b}" for b in touched}},
                    "retired": replaced}

        done = commit(spark, path, record)
        if done.state.get("folders", {}).get(str(touched[0])) == f"{version}/{_BUCKET}={touched[0]}":
            remove(spark, [f"{path}/{f}" for f in [*outdated, *written[:-1]]])
            return touched


def upsert_buckets(
    new: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], buckets: int = BUCKETS
) -> list[int]:
    """Bring `new` into the table: of a key the row with the highest `order` columns stays, on a tie the new one.

    Returns the buckets that were replaced. `buckets` counts when the table is created; about a gigabyte each is right.
    """
    rest = [c for c in new.columns if c not in keys and c not in order]
    best = [F.col(c).desc_nulls_last() for c in (*order, *rest)]
    return _change(new, path, keys, buckets, best, lambda old, changes: upsert(old, changes, keys, order))


def insert_buckets(
    new: DataFrame, path: str, keys: Sequence[str], order: Sequence[Column], buckets: int = BUCKETS
) -> list[int]:
    """Add the rows of `new` whose key the table lacks; the first by `order` wins within `new`."""
    return _change(new, path, keys, buckets, order, lambda old, changes: insert_ignore(old, changes, keys, order))


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return _scan(spark, path, latest(spark, path).state)


def look_up(spark: SparkSession, path: str, keys: Sequence[str], values: Sequence) -> DataFrame:
    """The row of one key, from the one bucket it can be in."""
    state = latest(spark, path).state
    kinds = {f["name"]: T._parse_datatype_json_value(f["type"]) for f in json.loads(state["schema"])["fields"]}
    typed = [F.lit(value).cast(kinds[key]).alias(key) for key, value in zip(keys, values)]
    number = spark.range(1).select(*typed).select(_bucket(keys, state["buckets"])).first()[0]
    same = F.lit(True)
    for key, value in zip(keys, typed):
        same = same & F.col(key).eqNullSafe(value)
    return _scan(spark, path, state, [number]).filter(same)
