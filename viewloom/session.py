"""Session settings and lineage cutting."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the library is tuned for. All of them are ordinary Spark options, so a cluster
# profile may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # List steps cost much time per byte, so small inputs may use all cores as well.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128KB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "viewloom",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cluster_conf(shuffle_bytes: int, cores: int, task_bytes: int = 128 << 20) -> dict[str, str]:
    """Partition counts for a job that shuffles about ``shuffle_bytes`` on ``cores`` cores.

    Every core gets work and no task more than ``task_bytes``; adaptive execution merges what
    turns out smaller.
    """
    partitions = max(2 * cores, -(-shuffle_bytes // task_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(2 * task_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(task_bytes),
        # A split hot key pays off although a later step may have to shuffle again.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared checkpoint folder; only a local session gets one of its own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="viewloom-checkpoint-")
    sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()


REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What queries run here have shuffled is removed as soon as each ends, and not when the driver happens to collect it.

    For results that are written or small; a frame that is run again shuffles again.
    """
    before = spark.conf.get(REMOVE_SHUFFLES, "false")
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(REMOVE_SHUFFLES, before)


#: Folders of the tables that this process has written and not yet removed, in order.
_written: list[str] = []


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Later steps read the columns they need from the written table instead of running the plan
    again, and lost executors cost no recomputation. ``remove_written`` removes such tables. The shuffles of ``df`` are removed at once.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/viewloom-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def written_tables() -> int:
    """How many written tables there are; a mark for ``remove_written``."""
    return len(_written)


def remove_written(spark: SparkSession, since: int = 0, *keep: DataFrame) -> None:
    """Remove the tables written after the mark ``since``, but those that ``keep`` reads.

    For the end of a step whose result is written itself: what is removed can't be read any more.
    """

    def plain(path: str) -> str:
        return re.sub("^file:/+", "/", path)

    kept = {plain(f.rsplit("/", 1)[0]) for df in keep for f in df.inputFiles()}
    left = []
    for path in _written[since:]:
        if plain(path) in kept:
            left.append(path)
            continue
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    _written[since:] = left
