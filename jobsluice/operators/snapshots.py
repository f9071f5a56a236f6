"""Comparison of datasets: parity, snapshots, retirement, archive."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _sides(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Both sides by key; null keys are equal to null keys."""
    pack = lambda df, side: df.select(*[F.col(k).alias(f"{side}_{k}") for k in keys], F.struct(*[c for c in df.columns if c not in keys]).alias(side))
    same = [F.col(f"_left_{k}").eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    both = pack(left, "_left").join(pack(right, "_right"), same, "full_outer")
    return both.select(*[F.coalesce(f"_left_{k}", f"_right_{k}").alias(k) for k in keys], "_left", "_right")


def differences(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """keys, kind of the rows that differ: ``left_only``, ``right_only`` or ``changed``; null values are equal."""
    kind = F.when(F.col("_right").isNull(), "left_only").when(F.col("_left").isNull(), "right_only").when(~F.col("_left").eqNullSafe(F.col("_right")), "changed")
    return _sides(left, right.select(*left.columns), keys).select(*keys, kind.alias("kind")).filter("kind is not null")


def lifecycle(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """keys, state of all rows of two snapshots: added, removed, changed or kept."""
    state = F.when(F.col("_left").isNull(), "added").when(F.col("_right").isNull(), "removed").when(F.col("_left").eqNullSafe(F.col("_right")), "kept").otherwise("changed")
    return _sides(before, after.select(*before.columns), keys).select(*keys, state.alias("state"))


def retire_safely(before: DataFrame, after: DataFrame, health: DataFrame, key: str, source: str) -> DataFrame:
    """key, source, state after a run: a row that is missing is retired if its source was healthy, else preserved.

    ``health`` has source and ok; a source without a line counts as failed.
    """
    old = before.select(key, F.col(source).alias("_old"))
    new = after.select(key, F.col(source).alias("_new"))
    rows = old.join(new, key, "full_outer").withColumn(source, F.coalesce("_new", "_old"))
    rows = rows.join(health.select(source, "ok"), source, "left")
    gone = F.when(F.coalesce("ok", F.lit(False)), "retired").otherwise("preserved")
    return rows.select(key, source, F.when(F.col("_new").isNull(), gone).when(F.col("_old").isNull(), "added").otherwise("kept").alias("state"))


def archive(rows: DataFrame, time: str, cutoff: Column) -> tuple[DataFrame, DataFrame]:
    """(live, archived with ``month``): rows before the cut-off go to the archive; rows without a time stay live."""
    old = F.coalesce(F.col(time) < cutoff, F.lit(False))
    return rows.filter(~old), rows.filter(old).withColumn("month", F.date_format(time, "yyyy-MM"))


def write_archive(old: DataFrame, path: str) -> None:
    """Archived rows (with ``month``) at ``path``: months that they hold are replaced whole, others stay.

    Writing the same rows again changes nothing. A large month is written by several tasks.
    """
    old.hint("rebalance", "month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)


def archived(spark: SparkSession, path: str, schema: StructType, months: list[str] | None = None) -> DataFrame:
    """The archive's rows of the months asked for, whose folders alone are read; ``schema`` is that of the rows, with month."""
    rows = spark.read.schema(schema).parquet(path)
    return rows if months is None else rows.filter(F.col("month").isin(months))


def whole_row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """kind of the rows that only one side has, each as often as it has more of them: for datasets without a known key.

    Columns that one side lacks are null there; equal rows are counted on both sides before they meet.
    """
    lack = lambda df, other: df.select(*df.columns, *[F.lit(None).cast(other.schema[c].dataType).alias(c) for c in other.columns if c not in df.columns])
    a, b = lack(left, right), lack(right, left)
    columns = sorted(a.columns)
    count = lambda df, sign: df.select(*columns).groupBy(*columns).agg((F.lit(sign) * F.count(F.lit(1))).alias("_n"))
    more = count(a, 1).unionByName(count(b, -1)).groupBy(*columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    return more.select(F.when(F.col("_n") > 0, "left_only").otherwise("right_only").alias("kind"), F.explode(F.sequence(F.lit(1), F.abs("_n").cast("int"))).alias("_k")).select("kind")


def parity_report(spark: SparkSession, pairs: list[tuple[str, str | None, str | None]], keys: dict[str, list[str]]) -> DataFrame:
    """dataset, kind, n: the differing rows of each pair of datasets (name, left path, right path), by kind.

    A dataset that one side lacks differs in all its rows; one without keys is compared by whole rows.
    """
    parts = []
    for name, left, right in pairs:
        if left and right and name not in keys:
            rows = whole_row_differences(spark.read.parquet(left), spark.read.parquet(right))
        elif left and right:
            rows = differences(spark.read.parquet(left), spark.read.parquet(right), keys[name]).select("kind")
        else:
            rows = spark.read.parquet(left or right).select(F.lit("left_only" if left else "right_only").alias("kind"))
        parts.append(rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("dataset"), "kind", "n"))
    if not parts:
        return spark.createDataFrame([], "dataset string, kind string, n long")
    return reduce(DataFrame.unionByName, parts)
