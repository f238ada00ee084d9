"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark import SparkContext
from pyspark.sql import SparkSession

# Settings the library relies on. Everything else is left to the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Checkpoint files go once nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "tallyworks", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library defaults, overridden by `conf` (pass dotted keys as `**{...}`)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cluster_conf(input_bytes: int, cores: int) -> dict[str, str]:
    """Split and shuffle sizes for a given input, to pass to `build_session(**...)`.

    Splits grow with the input, up to 1 GB each. Shuffles start with partitions of about 512 MB and at least two per
    core; AQE merges those that turn out small.
    """
    mib = 1 << 20
    split = min(max(input_bytes // 200_000, 128 * mib), 1024 * mib)
    shuffle = max(input_bytes // (512 * mib), 2 * cores)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(shuffle),
    }


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by `spark.checkpoint.dir`.

    Where that is not set, a folder in the session's warehouse, which the executors share as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tallyworks-shared"


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for an intermediate table; it is removed when this program ends."""
    if not _SCRATCH:
        atexit.register(_remove_scratch)
    _SCRATCH.append(f"{shared_dir(spark)}/tallyworks/{name}-{uuid.uuid4().hex}")
    return _SCRATCH[-1]


def _remove_scratch() -> None:
    if SparkContext._gateway is None:
        return
    jvm = SparkContext._gateway.jvm
    with contextlib.suppress(Exception):  # the session's Java side may be gone already
        conf = jvm.org.apache.hadoop.conf.Configuration()
        for path in _SCRATCH:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def enable_checkpoints(spark: SparkSession) -> None:
    """Make `DataFrame.checkpoint()` usable, keeping a folder that is already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
