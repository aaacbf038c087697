"""Sessions, tables and the shared folder where lineage is cut."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "marlstone", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and a UTC session time zone; conf overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in {**defaults, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share.

    Where the setting is absent a temporary folder is set, on a local master only: elsewhere executors would not
    see it, so its absence is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="marlstone-checkpoint-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back; its lineage ends there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """df as a compressed table in the shared folder, of which readers take the columns they need; deleted when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_drop, spark, path)
    return spark.read.parquet(path)


def _drop(spark: SparkSession, path: str) -> None:
    try:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    except Exception:  # noqa: BLE001 - the session has ended before; its folder is the cluster's to clear
        pass


def plan_size(df: DataFrame) -> int:
    """Catalyst's estimate of the bytes of df, an upper bound for scans and projections of them."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().longValue())
