"""Session settings, and the one place that knows the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[str] = []

# Settings the plans are written for. Nothing here depends on the data size:
# AQE picks partition counts, joins and skew splits from what it measures.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "andenlake", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local session that names none (tests, a laptop) gets a temporary folder;
    it is set on the context so that later calls agree on it. On a cluster such a
    folder would be on one machine, so naming none is an error there.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not is_local(context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="andenlake-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, known to ``clear_scratch``."""
    path = f"{shared_folder(spark)}/andenlake/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps that are done and written. It does so when
    the driver collects its garbage, which may else be long after."""
    gc.collect()
    jvm = getattr(spark, "_jvm", None)  # none on a Connect session, whose server does it
    if jvm is not None:
        jvm.System.gc()


def written(df: DataFrame, label: str, **options) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder, read it back.
    ``options`` are those of the Parquet writer.

    Values that depend on how rows were partitioned are frozen by this, so a
    lost executor cannot change them on recomputation.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> int:
    """Delete the tables that ``written`` made in this process; to be called once the
    frames that read them are no longer needed. Returns how many there were."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for path in _WRITTEN:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(hadoop).delete(folder, True)
    removed = len(_WRITTEN)
    _WRITTEN.clear()
    return removed
