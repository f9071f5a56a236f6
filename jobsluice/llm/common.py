"""What several operators share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsluice.sources.work import dropped, stored  # noqa: F401 (operators take them from here)

#: White space that separates words, as a character class body for Java's and DuckDB's regular expressions.
SPACES = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(name: str) -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


#: Keys that hold more than one in so many of all rows are hot. There are fewer of them than this, so they are broadcast.
HOT_KEYS = 10_000
#: Ids are broadcast up to this many, counted before; beyond it they are joined by a shuffle.
BROADCAST_IDS = 4_000_000


def join_counted(rows: DataFrame, right: DataFrame, keys: list[str], count: str, total: int, spread: list[str], outer: bool = False) -> DataFrame:
    """``rows`` that have their key in ``right``, with its other columns; a hot key's rows stay where they are.

    ``right`` is a stored table with one row for each key; ``count`` says how many of the ``total`` rows have the key.
    The first key is long, and the columns ``spread`` tell rows apart. With ``outer`` rows without their key stay too. Hot keys meet their rows by a broadcast
    of fewer than HOT_KEYS rows; the others by a shuffle in which none has more than one in HOT_KEYS of the rows.
    """
    others = [c for c in right.columns if c not in keys]
    hot = F.col(count) * HOT_KEYS > total
    packed = lambda df, name: df.select(*[F.col(k).alias(f"{name}_{k}") for k in keys], F.struct(*others).alias(name))
    same = lambda name, first: reduce(Column.__and__, [(first if i == 0 else F.col(k)) == F.col(f"{name}_{k}") for i, k in enumerate(keys)])
    near = rows.join(F.broadcast(packed(right.filter(hot), "_hot")), same("_hot", F.col(keys[0])), "left")
    near = near.withColumn("_key", F.when(F.col("_hot").isNull(), F.col(keys[0])).otherwise(F.xxhash64(*spread)))
    both = near.join(packed(right.filter(~hot), "_cold"), same("_cold", F.col("_key")), "left")
    found = both.withColumn("_found", F.coalesce("_hot", "_cold"))
    found = found if outer else found.filter("_found is not null")
    return found.select(*rows.columns, "_found.*")


def with_ids(rows: DataFrame, ids: DataFrame, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """(rows whose id is in ``ids``, the others). ``ids`` is a stored table of distinct ids without nulls."""
    small = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return rows.join(small, id_col, "left_semi"), rows.join(small, id_col, "left_anti")
