"""Spark session helpers.

The session is configured for the execution model the operators assume:
AQE on (runtime coalescing and skew-join splitting), UTC session time,
ANSI mode left at the Spark 4 default, no web UI.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

def get_spark(master: str | None = None, app: str = "scoutlab",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return (or create) a session with the settings the library expects."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("SCOUTLAB_DRIVER_MEMORY", "8g"))
    )
    if shuffle_partitions:  # else the cluster's own setting holds
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/S3/ABFS)
    folder and is used as is.  Where it is unset a scratch folder is made on a
    local master only; elsewhere a folder of the driver's machine would be of no
    use to the executors, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="scoutlab-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


class Shelf:
    """Tables written below the checkpoint folder and read back, with their true sizes and
    columns read apart; all go at the end of the ``with`` block."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.path, self.n = spark, f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}", 0

    def __enter__(self) -> Shelf:
        return self

    def put(self, df: DataFrame, instead: DataFrame | None = None) -> DataFrame:
        """``df`` as written; the table ``instead`` of which it stands is deleted."""
        self.n += 1
        path = f"{self.path}/{self.n}"
        df.write.parquet(path)
        if instead is not None:
            self._delete(instead._path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._path = path
        return out

    def _delete(self, path: str) -> None:
        file = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        file.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(file, True)

    def __exit__(self, *failure) -> None:
        self._delete(self.path)
