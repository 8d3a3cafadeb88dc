"""Session settings and the shared scratch area.

Every job in this package is plain DataFrame code; the only settings it relies
on are the ones below.  ``configure`` applies them to an existing session so a
cluster's own sizing (shuffle partitions, executor memory) is left alone.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the jobs assume.  Session time zone UTC: observation times are UTC
# wall clock; AQE re-plans joins from runtime sizes, splits skewed partitions
# and coalesces small ones; dynamic partition overwrite makes re-running one
# run / one day replace exactly its own partitions.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def cluster_settings(input_bytes: int, executors: int, cores_per_executor: int = 4,
                     target_partition_bytes: int = 256 << 20, shuffle_fraction: float = 0.1,
                     max_partitions: int = 100_000) -> dict[str, str]:
    """Sizing for a cluster run over ``input_bytes`` of scanned data.

    Shuffles carry projected columns and partial aggregates, typically a
    tenth of the scanned bytes or less (``shuffle_fraction``).  The initial
    shuffle partition count gives ~256 MB per partition for that volume,
    never below twice the task slots and capped (map-status metadata grows
    with map tasks x partitions); AQE then coalesces small partitions to the
    advisory size and splits skewed ones.  Scan splits of 512 MB keep the
    task count of a 100 TB scan near 200k.
    """
    slots = max(1, executors * cores_per_executor)
    shuffle_bytes = int(input_bytes * shuffle_fraction)
    partitions = min(max_partitions, max(2 * slots, -(-shuffle_bytes // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def configure(spark: SparkSession) -> SparkSession:
    for k, v in SESSION_SETTINGS.items():
        spark.conf.set(k, v)
    return spark


@contextmanager
def with_settings(spark: SparkSession, settings: dict[str, str]):
    """Session settings for the writes or streams started within."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pumpline") -> SparkSession:
    """A local session for tests and the bench (the cluster builds its own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SESSION_SETTINGS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a location every executor reaches); a
    missing setting is an error there.  Only a local-mode session (tests)
    gets a folder of its own when none is set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # pragma: no cover - Spark Connect has no SparkContext
            root = None
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: point it at a shared folder of the cluster")
        root = tempfile.mkdtemp(prefix="pumpline-ckpt-")
        spark.sparkContext.setCheckpointDir(root)  # found again by getCheckpointDir
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)
    except Exception:  # pragma: no cover - Spark Connect has no SparkContext
        pass
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/pumpline/{name}-{uuid.uuid4().hex[:12]}"


def app_key(spark: SparkSession) -> str:
    """An id of the running application (works without a SparkContext)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # pragma: no cover - Spark Connect
        return spark.conf.get("spark.app.id", None) or str(id(spark))
