"""Incremental intake: only files that came since the last run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def new_rows(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """A stream of the Parquet files in ``path``."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_available(rows: DataFrame, out: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Handle what is there, write it to ``out`` and stop; the checkpoint remembers what was read."""
    query = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_each(rows: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update") -> StreamingQuery:
    """The same with a function for each batch, called again with the same number after a failure."""
    query = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
