"""Spark session and shared scratch space.

Cluster jobs get their settings from ``spark-submit`` / ``spark-defaults``;
``build_session`` is for tests, local runs and the benchmark. ``scratch_dir``
returns a folder under ``spark.checkpoint.dir`` (the shared folder the cluster
names), and only picks a local temporary folder when the session runs in local
mode and no checkpoint folder is configured.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; all are public Spark SQL options.
SCALE_CONF = {
    # Adaptive execution: coalesce small shuffle partitions, split skewed
    # join partitions, switch to broadcast when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Many small hourly CSV files: pack them into fewer scan tasks.
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.files.openCostInBytes": "8m",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "dailybars", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_scale_defaults(spark: SparkSession) -> None:
    """Apply SCALE_CONF to a running session for every key the submitter did
    not set (spark-submit / spark-defaults settings win)."""
    submitted = spark.sparkContext.getConf()
    for key, value in SCALE_CONF.items():
        if not submitted.contains(key):
            spark.conf.set(key, value)


# Target bytes of input per initial shuffle partition.
SHUFFLE_BYTES_PER_PARTITION = 64 * 1024 * 1024


def size_shuffle(spark: SparkSession, input_bytes: int, most: int = 100_000) -> int:
    """Start adaptive execution with enough shuffle partitions for the input
    (about 64 MB of input each), never fewer than configured and not more than
    ``most``; AQE then coalesces the small ones. Returns the initial partition
    count."""
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    configured = int(spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(most, -(-max(0, input_bytes) // SHUFFLE_BYTES_PER_PARTITION))
    partitions = max(configured, wanted)
    spark.conf.set(key, str(partitions))
    return partitions


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS / object store) that every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="dailybars-ckpt-"))
    return sc.getCheckpointDir()


_SCRATCH: dict[str, list[str]] = {}


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder, for ``clean_scratch``."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/dailybars-scratch/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_count(spark: SparkSession) -> int:
    """How many scratch folders are kept: a mark for ``clean_scratch``."""
    return len(_SCRATCH.get(spark.sparkContext.applicationId, []))


def clean_scratch(spark: SparkSession, since: int = 0, keep: int = 0) -> int:
    """Delete the scratch folders this application has made so far (after the
    mark ``since``, but for the ``keep`` newest); call it when no DataFrame that
    reads them is needed any more. Returns how many."""
    made = _SCRATCH.get(spark.sparkContext.applicationId, [])
    stop = max(len(made) - keep, since)
    paths, made[since:stop] = made[since:stop], []
    conf = spark._jsc.hadoopConfiguration()
    for text in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(text)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)
