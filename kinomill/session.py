"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this library expects. The caller's cluster sets sizes
# (executors, memory, shuffle partitions); these only fix semantics and AQE.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key's side of a join even if the aggregate above needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Shuffle files go when the job that wrote them ends, not when the driver happens to collect garbage: long jobs fill no disk.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def apply_conf(spark: SparkSession) -> SparkSession:
    """Set the run-time settings on a session the caller owns."""
    for key, value in RECOMMENDED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("kinomill")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        # Checkpoint files go when their frames do. Read when a session starts: clusters set it themselves.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="kinomill-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark).rstrip('/')}/{app}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df, name: str = "stored"):
    """``df`` written below the shared folder and read back, with the path for ``discard``."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``stored`` made, on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df):
    """Reliable checkpoint of ``df``; survives the loss of executors."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
