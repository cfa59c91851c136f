"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # list-wise kernels do much work per byte: do not merge small partitions into one task
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a query's shuffle files go when it ends, so loops and staged plans hold those of one step
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime options the operators rely on (idempotent)."""
    for key, value in _RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder visible to driver and executors, named by ``spark.checkpoint.dir``.

    A private folder is created only on a local master, where driver and
    executors are one process; a cluster without the setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tasteloom-"))
    return context.getCheckpointDir().rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/stages/{app}/{name}-{uuid.uuid4().hex}"


def drop_stage(df: DataFrame) -> None:
    """Delete the files of a table that ``write_stage`` made, once nothing reads it any more."""
    files = df.inputFiles()
    above, _, below = files[0].rpartition("/stages/") if files else ("", "", "")
    if not above:
        return
    folder = f"{above}/stages/{'/'.join(below.split('/')[:2])}"      # application and stage, without folders of ``by``
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def write_stage(df: DataFrame, name: str = "stage", by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    Cuts lineage in loops, survives lost executors, and gives the optimizer
    real sizes for the next join. With ``by`` rows of one value of that column
    have their own folder, so that a filter on it reads no others.
    """
    path = stage_path(df.sparkSession, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
