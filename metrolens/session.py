"""Session construction and the shared folder used for staging and checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings every metrolens job expects. Callers may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


# The scope that staged tables belong to, if one is open (see metrolens.staging).
CURRENT_SCOPE: ContextVar = ContextVar("metrolens_staging_scope", default=None)


def build_session(
    master: str | None = "local[8]",
    app_name: str = "metrolens",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with AQE on and the UI off.

    ``master=None`` takes what spark-submit provides. Without
    ``shuffle_partitions`` a local master gets 8 and a cluster keeps its own
    setting; size it with :func:`cluster_conf` (passed as ``extra_conf``).
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is None and master is not None and master.startswith("local"):
        shuffle_partitions = 8
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of this session.

    On a cluster this is the folder named by ``spark.checkpoint.dir``. Only
    a local-mode session (tests) that has none gets a private folder; any
    other master without one is an error, since executors on other machines
    could not read a folder local to the driver. A session without a
    SparkContext (Spark Connect) uses the conf value.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect sessions expose no SparkContext
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="metrolens-checkpoints-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder, in the open scope's folder if there is one."""
    scope = CURRENT_SCOPE.get()
    root = scope.root if scope is not None else f"{checkpoint_dir(spark).rstrip('/')}/staging"
    return f"{root}/{name}-{uuid.uuid4().hex}"


def clear_staging(spark: SparkSession) -> bool:
    """Delete everything that this session staged under its checkpoint folder.

    Call it when no DataFrame built on staged data is needed any more. Returns
    whether there was anything to delete.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/staging")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and return
    the lazy read of it.

    Cuts lineage in one pass (a reliable ``checkpoint()`` of an unpersisted
    plan computes it twice: once for the action, once for the write), and the
    files survive the loss of any executor.
    """
    return materialize_observed(df, name, {})[0]


def materialize_observed(df: DataFrame, name: str, metrics: dict[str, Column]) -> tuple[DataFrame, dict]:
    """:func:`materialize`, also returning aggregate ``metrics`` (name ->
    aggregate expression) computed during the same write job."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    observation = None
    if metrics:
        observation = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        df = df.observe(observation, *[expr.alias(key) for key, expr in metrics.items()])
    schema = df.schema
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path), (observation.get if observation else {})


def cluster_conf(
    shuffle_bytes: float,
    total_cores: int,
    target_partition_bytes: int = 256 * 1024 * 1024,
    max_shuffle_partitions: int = 100_000,
) -> dict[str, str]:
    """Settings that keep shuffle and scan partitions near ``target_partition_bytes``.

    ``shuffle_bytes`` is the expected size of the largest shuffle (after
    column pruning and partial aggregation, usually far below the input
    size). The initial partition count is an upper bound that AQE coalesces
    down at run time; it is capped because the driver tracks map x reduce
    statuses. Skewed partitions above 4x the median and 1 GiB are split.
    """
    partitions = int(min(max_shuffle_partitions, max(2 * total_cores, -(-shuffle_bytes // target_partition_bytes))))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
    }
