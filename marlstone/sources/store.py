"""Tables on disk: package-wise stages, snapshots behind a pointer, content-addressed files, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.versioning import same_content


def write_stage(df: DataFrame, path: str, package: str = "package_id") -> None:
    """Writes a package's rows; the same package again replaces its own partition and no other (a retry leaves no copies)."""
    df.write.option("partitionOverwriteMode", "dynamic").partitionBy(package).mode("overwrite").parquet(path)


def drop_package(spark: SparkSession, path: str, package: str, value: str) -> None:
    """Removes one package's partition from a stage."""
    _delete(spark, f"{path}/{package}={value}")


def append_history(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place, jvm.org.apache.hadoop.fs.Path


def _delete(spark: SparkSession, path: str) -> None:
    files, place, _ = _files(spark, path)
    files.delete(place, True)


def current_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """The table that the newest pointer names, None before the first."""
    files, place, make = _files(spark, path)
    if not files.exists(place):
        return None
    done = sorted(s.getPath().getName() for s in files.listStatus(place) if s.getPath().getName().startswith("pointer-"))
    return spark.read.parquet(f"{path}/snapshot-{done[-1].removeprefix('pointer-')}") if done else None


def publish_snapshot(df: DataFrame, path: str, version: int, check: bool = True, keep: int = 2) -> None:
    """Writes a snapshot, compares what was written with what was made, and only then makes it current by one empty pointer file.

    Count and fingerprint of df are observed while it is written, so df is computed once.

    A reader sees the old table until the pointer stands; a run that breaks off leaves no half table behind a
    pointer. Older snapshots but `keep` are deleted.
    """
    spark = df.sparkSession
    target = f"{path}/snapshot-{version:020d}"
    seen = Observation()
    measures = [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("h")]
    df.observe(seen, *measures).write.mode("overwrite").parquet(target)
    if check and tuple(spark.read.parquet(target).agg(*measures).first()) != (seen.get["n"], seen.get["h"]):
        raise RuntimeError("the snapshot does not hold what was to be written")
    files, _, make = _files(spark, path)
    files.create(make(f"{path}/pointer-{version:020d}"), True).close()
    done = sorted(s.getPath().getName() for s in files.listStatus(make(path)) if s.getPath().getName().startswith("pointer-"))
    for old in done[:-keep]:
        _delete(spark, f"{path}/{old}")
        _delete(spark, f"{path}/{old.replace('pointer-', 'snapshot-')}")


def compact(spark: SparkSession, path: str, files: int) -> None:
    """Rewrites a table into so many files, by way of a shadow that must hold the same rows before it takes the table's place.

    A table of publish_snapshot is rewritten as its next version, so that one pointer file makes the change and
    a reader always finds a table. A plain table is moved by two renames; a run that broke off between them is
    put right by the next one, which finds the old table beside an empty place.
    """
    fs, place, make = _files(spark, path)
    old = make(f"{path}__old")
    if fs.exists(place) and (current := current_snapshot(spark, path)) is not None:
        publish_snapshot(current.repartition(files), path, _versions(fs, place)[-1] + 1)
        return
    if fs.exists(old):
        if not fs.exists(place):
            fs.rename(old, place)
        fs.delete(old, True)
    shadow = f"{path}__shadow"
    before = spark.read.parquet(path)
    before.repartition(files).write.mode("overwrite").parquet(shadow)
    if not same_content(before, spark.read.parquet(shadow)):
        raise RuntimeError("the compacted table does not hold the same rows")
    fs.rename(place, old)
    fs.rename(make(shadow), place)
    fs.delete(old, True)


def _versions(files, place) -> list[int]:
    names = [s.getPath().getName() for s in files.listStatus(place)]
    return sorted(int(n.removeprefix("pointer-")) for n in names if n.startswith("pointer-"))


def store_assets(df: DataFrame, content: str, root: str) -> DataFrame:
    """(sha256, storage_key) of binary rows, each content written once under its hash (sha[:2]/sha[2:4]/sha).

    Written by partitions; a file is completed under a name of its own and then takes its place in one step, so
    a lost executor leaves no half asset, and tasks that write one content at once leave that content. root
    must be a folder that all executors share.
    """

    def run(batches):
        import hashlib
        import os
        import uuid
        from pathlib import Path

        import pandas as pd

        for frame in batches:
            out = []
            for data in frame[content]:
                digest = hashlib.sha256(bytes(data)).hexdigest()
                key = f"{digest[:2]}/{digest[2:4]}/{digest}"
                path = Path(root) / key
                if not path.exists():
                    path.parent.mkdir(parents=True, exist_ok=True)
                    part = path.with_name(f"{digest}.{uuid.uuid4().hex}.part")
                    part.write_bytes(bytes(data))
                    os.replace(part, path)
                out.append((digest, key))
            yield pd.DataFrame(out, columns=["sha256", "storage_key"])

    return df.where(F.col(content).isNotNull()).select(content).mapInPandas(run, "sha256 string, storage_key string").distinct()


def export(df: DataFrame, path: str, kind: str = "csv") -> None:
    """A table as csv with a header, json lines or parquet; structures go to JSON text for csv."""
    if kind == "csv":
        flat = [F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes]
        df.select(*flat).write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
    elif kind == "json":
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    else:
        df.write.mode("overwrite").parquet(path)
