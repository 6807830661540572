"""Session helpers: shared folders and planner settings.

Nothing here creates a session; callers pass theirs in.
"""

from __future__ import annotations

import posixpath
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings the plans are written for. AQE re-plans joins from runtime sizes
# (small shuffle outputs become broadcast joins, skewed partitions are split),
# and coalesces small shuffle partitions. The static broadcast threshold only
# applies to relations whose plan statistics are known and small.
PLANNER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


# Target bytes per shuffle partition and per scan split: small enough that a
# task's sort and hash buffers fit in executor memory without heavy spilling,
# large enough that task overhead stays small.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024
MIN_SHUFFLE_PARTITIONS = 200


def scale_settings(input_bytes: int, *, target_partition_bytes: int = TARGET_PARTITION_BYTES) -> dict[str, str]:
    """Partition sizing for a run over ``input_bytes`` of (compressed) input.

    The initial shuffle partition count is sized for the largest shuffle (a
    fact shuffled on a lookup key moves about as many bytes as it reads) so
    that no partition starts far above the target; AQE then coalesces small
    partitions towards the advisory size and splits skewed ones. Scan splits
    use the same target.
    """
    parts = max(MIN_SHUFFLE_PARTITIONS, -(-max(int(input_bytes), 1) // target_partition_bytes))
    size = str(target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def tune(spark: SparkSession, *, input_bytes: int | None = None) -> SparkSession:
    """Apply :data:`PLANNER_SETTINGS` (and, given the input volume,
    :func:`scale_settings`) to a running session (runtime SQL confs)."""
    settings = dict(PLANNER_SETTINGS)
    if input_bytes is not None:
        settings.update(scale_settings(input_bytes))
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    A session on a local master (a test), where every task runs on this
    machine, gets a fresh local folder if the setting is missing. On a cluster
    a missing setting is an error: executors could not see a local folder.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all executors of {master} share")
        base = tempfile.mkdtemp(prefix="regstar-shared-")
        spark.conf.set(CHECKPOINT_CONF, base)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder name under :func:`shared_root`."""
    return posixpath.join(shared_root(spark), "regstar", *parts, uuid.uuid4().hex)


def remove_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder that :func:`shared_dir` named, in whatever store holds it."""
    if "/regstar/" not in path:
        raise ValueError(f"{path} is not a folder of shared_dir")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and return a frame
    that reads it back: columns are pruned and filters pushed on reading, and
    a lost executor costs a re-read, not the lineage."""
    path = shared_dir(df.sparkSession, "tables")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
