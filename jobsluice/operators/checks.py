"""Validation, back-fill, active windows, dimension guards and rotation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


def failures(rules: dict[str, Column]) -> Column:
    """Sorted names of the rules that a row breaks; a rule that is null counts as broken."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in sorted(rules.items())]
    return F.filter(F.array(*broken), lambda r: r.isNotNull())


def validate(rows: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their ``reasons``); together they are the input."""
    judged = rows.withColumn("reasons", failures(rules))
    return judged.filter(F.size("reasons") == 0).drop("reasons"), judged.filter(F.size("reasons") > 0)


def validate_in_passing(rows: DataFrame, rules: dict[str, Column], path: str) -> dict[str, int]:
    """Write the judged rows (with ``reasons``) to ``path``; how many rows there are, and how many break each rule.

    The counts come from the tasks that write, without a scan of their own. An empty table has zeros.
    """
    watch = Observation()
    broken = [F.count_if(F.array_contains("reasons", name)).alias(name) for name in sorted(rules)]
    judged = rows.withColumn("reasons", failures(rules))
    judged.observe(watch, F.count(F.lit(1)).alias("rows"), *broken).write.mode("overwrite").parquet(path)
    return watch.get


def active(rows: DataFrame, time: str, as_of: Column, days: int) -> DataFrame:
    """Rows within ``days`` days up to a given date; the bounds stand alone, so that scans can use them."""
    return rows.filter((F.col(time) > F.date_sub(as_of, days)) & (F.col(time) < F.date_add(as_of, 1)))


def backfill(rows: DataFrame, side: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Missing values taken from a side table, by key."""
    other = side.select(key, *[F.col(c).alias(f"_side_{c}") for c in columns])
    joined = rows.join(other, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c) if c in rows.columns else F.lit(None), f"_side_{c}") for c in columns}).drop(*[f"_side_{c}" for c in columns])


def duplicate_keys(rows: DataFrame, key: str, name: str) -> DataFrame:
    n = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.lit(name).alias("check_name"), "n")


def orphans(rows: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    n = rows.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti").agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.lit(name).alias("check_name"), "n")


def blanks(rows: DataFrame, column: str, name: str) -> DataFrame:
    n = rows.agg(F.count_if(F.coalesce(F.trim(column), F.lit("")) == "").alias("n"))
    return n.select(F.lit(name).alias("check_name"), "n")


def rotation(sources: DataFrame, source: str, item: str, seen: str, per_source: int, budget: int) -> DataFrame:
    """source, item, turn: the stalest items of each source, ``per_source`` first, then what the budget leaves.

    An item's rank in its source says when it is served; those beyond the source's share wait for the unused budget
    by staleness. Of the ranked rows at most ``budget`` are taken.
    """
    own = Window.partitionBy(source).orderBy(seen, item)
    ranked = sources.withColumn("_k", F.row_number().over(own))
    chosen = ranked.withColumn("_extra", (F.col("_k") > per_source).cast("int"))
    picked = chosen.orderBy("_extra", seen, source, item).limit(budget)
    return picked.select(source, item, F.col("_k").cast("long").alias("turn"))
