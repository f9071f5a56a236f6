"""Datasets on object stores and other file systems that Spark reads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def object_path(bucket: str, key: str, scheme: str = "s3a") -> str:
    """``s3a://bucket/key``; with an empty bucket the key itself, for local folders in tests."""
    return f"{scheme}://{bucket}/{key.strip('/')}" if bucket else key


def write_dataset(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """Parquet at ``path``; rows of one partition value are brought together, so that few files come of it."""
    rows = df.repartition(*partition_by) if partition_by else df
    rows.write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_dataset(spark: SparkSession, path: str, schema=None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def dataset_pairs(spark: SparkSession, left: str, right: str) -> list[tuple[str, str | None, str | None]]:
    """(name, left path, right path) of all datasets in either folder; None where a side lacks one."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    sides: list[dict[str, str]] = []
    for folder in (left, right):
        path = hadoop(folder)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        sides.append({n: f"{folder.rstrip('/')}/{n}" for n in names if not n.startswith(("_", "."))})
    return [(n, sides[0].get(n), sides[1].get(n)) for n in sorted(sides[0] | sides[1])]


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Names of a published dataset's complete versions, oldest first."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_versions")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def publish(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), keep: int = 2, last_step: bool = True) -> str:
    """Replace the dataset at ``path`` so that readers see the old rows or the new ones, never a mixture; returns the version.

    Rows go to a folder of their own; an empty file in ``_versions``, made when all rows are there, makes them current.
    Its name says it all, so that it needs no rename and no lock, which object stores lack. A job that fails before leaves the
    old version current, and may run again. Of two writers at once the one with the greater name wins, whole. ``df`` may
    read the dataset itself. All but the last ``keep`` versions are deleted after; readers that started before have
    time up to the ``keep``-th next publication. Without ``last_step`` nothing becomes current (for tests of that).
    """
    spark, base = df.sparkSession, path.rstrip("/")
    known = _versions(spark, base)
    version = f"{int(known[-1].split('-')[0]) + 1 if known else 1:012d}-{uuid.uuid4().hex}"
    write_dataset(df, f"{base}/{version}", partition_by, "errorifexists")
    if last_step:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        mark = hadoop(f"{base}/_versions/{version}")
        fs = mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.create(mark, False).close()
        for old in _versions(spark, base)[:-keep]:
            fs.delete(hadoop(f"{base}/_versions/{old}"), False)
            fs.delete(hadoop(f"{base}/{old}"), True)
    return version


def read_published(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The current version of a published dataset; an error where nothing was published."""
    known = _versions(spark, path)
    if not known:
        raise FileNotFoundError(f"nothing is published at {path}")
    return read_dataset(spark, f"{path.rstrip('/')}/{known[-1]}", schema)
