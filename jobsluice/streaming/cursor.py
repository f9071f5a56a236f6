"""Intake by cursor: a mark for each source says how far it was read, and a batch that is run again changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class CursorIntake:
    """Data and marks at a path, each in a folder for each batch.

    Rows of a source are new if their cursor is beyond the source's mark, or at it with an id that was not taken. A batch
    reads the marks of the batches before it and writes its data first, then its marks, which commit it: one that fails in
    between is run again under its number and overwrites what it left.
    """

    def __init__(self, spark: SparkSession, path: str, source: str, cursor: str, key: str) -> None:
        self.spark, self.path, self.source, self.cursor, self.key = spark, path, source, cursor, key

    def next_batch(self) -> int:
        """The number after the last committed batch; 0 before the first."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/marks")
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return 0
        done = lambda s: fs.exists(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))
        numbers = [int(s.getPath().getName().removeprefix("batch=")) for s in fs.listStatus(folder) if s.getPath().getName().startswith("batch=") and done(s)]
        return max(numbers, default=-1) + 1

    def marks(self, rows: DataFrame, before: int) -> DataFrame:
        """source, mark: how far each source was read by the batches before a number."""
        kinds = f"{self.source} {rows.schema[self.source].dataType.simpleString()}, mark {rows.schema[self.cursor].dataType.simpleString()}, batch long"
        if before == 0:
            return self.spark.createDataFrame([], kinds).drop("batch")
        marks = self.spark.read.schema(kinds).parquet(f"{self.path}/marks").filter(F.col("batch") < before)
        return marks.groupBy(self.source).agg(F.max("mark").alias("mark"))

    def new_rows(self, rows: DataFrame, number: int) -> DataFrame:
        """The rows that the batches before ``number`` have not taken; rows without a cursor never are."""
        marks = self.marks(rows, number).withColumnRenamed(self.source, "_source")
        known = rows.join(marks, F.col(self.source).eqNullSafe(F.col("_source")), "left").drop("_source")
        beyond = known.filter(F.col(self.cursor).isNotNull() & (F.col("mark").isNull() | (F.col(self.cursor) > F.col("mark")))).drop("mark")
        if number == 0:
            return beyond
        tied = known.filter(F.col(self.cursor) == F.col("mark")).drop("mark")
        taken = self.data(rows, number).select(*[F.col(c).alias(f"_{c}") for c in (self.source, self.cursor, self.key)])
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (self.source, self.cursor, self.key)]
        return beyond.unionByName(tied.join(taken, same, "left_anti"))

    def data(self, rows: DataFrame, before: int | None = None) -> DataFrame:
        """What the committed batches have taken, with ``batch``; of those before a number, if one is given."""
        taken = self.spark.read.schema(rows.schema.add("batch", "long") if "batch" not in rows.columns else rows.schema).parquet(f"{self.path}/data")
        return taken.filter(F.col("batch") < (self.next_batch() if before is None else before))

    def run(self, rows: DataFrame, commit: bool = True) -> int:
        """Take what is new in ``rows`` as the next batch, and return its number. Without ``commit`` it stops before the marks."""
        number = self.next_batch()
        self.new_rows(rows, number).write.mode("overwrite").parquet(f"{self.path}/data/batch={number}")
        if commit:
            written = self.spark.read.schema(rows.schema).parquet(f"{self.path}/data/batch={number}")
            written.groupBy(self.source).agg(F.max(self.cursor).alias("mark")).write.mode("overwrite").parquet(f"{self.path}/marks/batch={number}")
        return number
