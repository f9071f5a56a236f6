"""Deduplication by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of each key the first row in ``order``.

    The first is found by an aggregate, which runs before the shuffle too: a hot key sends one row from each task.
    """
    others = [c for c in rows.columns if c not in keys]
    first = F.min_by(F.struct(*others), F.struct(*order))
    return rows.groupBy(*keys).agg(first.alias("_first")).select(*keys, "_first.*").select(*rows.columns)


def drop_within_ttl(rows: DataFrame, key: Column, time: str, seconds: float, tie: str) -> DataFrame:
    """Rows whose key has no row in the ``seconds`` before them: a gap rule, by which each row prolongs its key's life."""
    before = F.lag(time).over(Window.partitionBy(key).orderBy(time, tie))
    gap = F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(before.cast("timestamp"))
    return rows.withColumn("_gap", gap).filter(F.col("_gap").isNull() | (F.col("_gap") > int(seconds * 1_000_000))).drop("_gap")


def drop_seen(rows: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not in ``seen``; null keys are equal to null keys."""
    listed = seen.select(*[F.col(k).alias(f"_seen_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_seen_{k}")) for k in keys]
    return rows.join(listed, same, "left_anti")


def upsert_seen(seen: DataFrame, today: DataFrame, key: str) -> DataFrame:
    """The next snapshot of a seen table (key, first_seen, last_seen): ``today`` (key, day) adds keys or renews them."""
    new = today.groupBy(key).agg(F.min("day").alias("_first"), F.max("day").alias("_last"))
    joined = seen.join(new, key, "full_outer")
    return joined.select(key, F.coalesce("first_seen", "_first").alias("first_seen"), F.coalesce(F.greatest("last_seen", "_last"), "last_seen", "_last").alias("last_seen"))


def capped(rows: DataFrame, group: str, order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows of each group, with their ``rank`` from 1; the limit applies before the shuffle too."""
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.filter(F.col("rank") <= most).withColumn("rank", F.col("rank").cast("long"))
