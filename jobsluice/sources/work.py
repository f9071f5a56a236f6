"""Working folders that the driver and all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, name: str = "jobsluice") -> str:
    """A new folder below spark.checkpoint.dir.

    Where that setting is missing a local folder stands in if Spark runs on one machine; a cluster is refused, as each
    executor would write to a disk of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "jobsluice-checkpoints")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to a shared folder and read it back: lineage is cut and a lost executor costs nothing.

    The folder lives as long as the application's checkpoints do, or up to ``dropped``.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._stored_path = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing will read again."""
    for table in tables:
        path = getattr(table, "_stored_path", None)
        if path:
            context = table.sparkSession.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(os.path.dirname(path))
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
