"""Session construction and cluster-safe checkpointing."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the pipeline relies on. ANSI stays on: the money cast (P7) must
# raise on malformed input exactly like the warehouse's hard cast.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Starting point for a large cluster (100 TB inputs, ~1000 executors). The
# shuffle starts wide and AQE coalesces it to the advisory size at runtime;
# scan splits and shuffle blocks stay far below executor memory; explicit
# broadcasts are size-checked in code, the planner's own threshold is modest.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "lodgeflow",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the pipeline's settings.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset, pass
    ``conf=CLUSTER_CONF`` (or the submit configuration's own values) and set
    ``spark.checkpoint.dir`` to a shared folder; AQE coalesces small shuffles
    at runtime.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it if needed.

    The cluster names its shared folder in ``spark.checkpoint.dir``; that
    setting always wins. Only a local-mode session (tests, laptops) without
    one gets a private temporary folder; on a cluster a missing setting is an
    error, because a machine-local folder does not survive executor loss.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 — Spark Connect: the server owns the setting
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the server session")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="lodgeflow-ckpt-")
        sc.setCheckpointDir(folder)
        return sc.getCheckpointDir() or folder
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a shared folder "
        "(HDFS/S3/ABFS) so iterative jobs can cut lineage safely")


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a table in the shared checkpoint folder and return
    a DataFrame that reads it back, which cuts the lineage.

    A written table (rather than ``Dataset.checkpoint``) runs the plan once,
    lets AQE coalesce the output to right-sized files (a persisted plan keeps
    every shuffle partition), and stores the rows columnar and compressed.
    The folder is the one named by ``spark.checkpoint.dir`` — shared storage
    on a cluster, so the result survives lost executors; treat it as scratch
    space, like Spark's own checkpoint files.
    """
    folder = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{folder}/lodgeflow-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.parquet(path)


# Tables written by ``reliable_checkpoint`` in this process, oldest first.
_WRITTEN: list[str] = []


def release_checkpoints(spark: SparkSession) -> int:
    """Delete the checkpoint tables this process wrote; returns how many.

    Call it once the job's outputs are written: DataFrames returned by
    ``reliable_checkpoint`` read those tables and must not be used afterwards.
    """
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        return 0
    conf = spark._jsc.hadoopConfiguration()
    released = 0
    while _WRITTEN:
        jpath = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        if jpath.getFileSystem(conf).delete(jpath, True):
            released += 1
    return released


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder on its own file system (nothing happens if it is missing)."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on its file system (local, HDFS, object stores)."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:  # Spark Connect: ask the server by listing the path
        from pyspark.errors import AnalysisException

        try:
            spark.read.format("binaryFile").load(path).limit(0).collect()
            return True
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" in (exc.getCondition() or ""):
                return False
            raise  # any other error says nothing about the path
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath))
