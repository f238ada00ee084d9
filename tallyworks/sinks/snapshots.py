"""Which folders a stored table consists of: one small record per version, put in place in one step.

Data go to folders of their own first; a record naming them follows and makes them count. A reader takes the newest record
and sees exactly its folders. A writer that another one was quicker than finds its number taken and starts again from
the newer record, so no change is lost. Folders that a record no longer names stay until the next clean-up, for readers that
still hold the record before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

RECORDS = "_snapshots"
KEPT_RECORDS = 8


class Snapshot(NamedTuple):
    """A version number (0: no table yet) and what its record says."""

    version: int
    state: dict


def _at(spark: SparkSession, path: str):
    """(file context, Java path) of a path in any file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    where = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where)
    return hadoop.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration()), where


def small_files(spark: SparkSession, folder: str) -> list[str]:
    """The names of the files of a folder of records, in order."""
    context, where = _at(spark, folder)
    if not context.util().exists(where):
        return []
    found = context.util().listStatus(where)
    return sorted(name for name in (status.getPath().getName() for status in found) if not name.startswith("."))


def read_small(spark: SparkSession, path: str) -> str:
    context, where = _at(spark, path)
    stream = context.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place, whole or not at all; False where there is one already."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    folder, name = path.rsplit("/", 1)
    context, draft = _at(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    _, final = _at(spark, path)
    options = jvm.org.apache.hadoop.fs.Options
    parents = gateway.new_array(options.CreateOpts, 1)
    parents[0] = options.CreateOpts.createParent()
    flags = jvm.java.util.EnumSet.of(jvm.org.apache.hadoop.fs.CreateFlag.CREATE)
    stream = context.create(draft, flags, parents)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        context.rename(draft, final, gateway.new_array(options.Rename, 0))
    except Py4JJavaError as refused:
        context.delete(draft, False)
        if "FileAlreadyExistsException" in str(refused.java_exception.getClass().getName()):
            return False
        raise
    return True


def replace_file(spark: SparkSession, source: str, target: str) -> None:
    """Move a file to its final name, over an older one of that name."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    context, start = _at(spark, source)
    _, end = _at(spark, target)
    context.mkdir(end.getParent(), None, True)
    how = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "OVERWRITE")
    context.rename(start, end, how)


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        context, where = _at(spark, path)
        if context.util().exists(where):
            context.delete(where, True)


def latest(spark: SparkSession, path: str) -> Snapshot:
    records = small_files(spark, f"{path}/{RECORDS}")
    if not records:
        return Snapshot(0, {})
    return Snapshot(int(records[-1]), json.loads(read_small(spark, f"{path}/{RECORDS}/{records[-1]}")))


def commit(spark: SparkSession, path: str, change: Callable[[Snapshot], dict | None]) -> Snapshot:
    """Replace the newest record by `change` of it, again for as long as other writers come first.

    `change` returns None where there is nothing to do. Returns the record that holds then.
    """
    while True:
        before = latest(spark, path)
        state = change(before)
        if state is None:
            return before
        after = Snapshot(before.version + 1, state)
        if create_once(spark, f"{path}/{RECORDS}/{after.version:012d}", json.dumps(state)):
            old = small_files(spark, f"{path}/{RECORDS}")[:-KEPT_RECORDS]
            remove(spark, [f"{path}/{RECORDS}/{name}" for name in old])
            return after


def new_folder(name: str) -> str:
    """A folder name, unique within the table, in the form of a partition, so that a plain read finds all files."""
    return f"folder={name}-{uuid.uuid4().hex}"
