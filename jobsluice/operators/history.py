"""History of snapshots as intervals of validity, and sketches that merge over periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jobsluice.sources.work import stored

#: Parts that a history is kept in; a merge writes those anew that hold a changed key.
PARTS = 64


def _part(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int").alias("part")


def folded(changes: DataFrame, key: str) -> DataFrame:
    """key, value, since, until from (key, at, value): the state of each key from a snapshot on up to another.

    ``value`` is a struct, null where the key is not in the snapshot; ``until`` is null where the state still holds. Of each
    key the changes are put in order; states that equal the one before add nothing.
    """
    order = Window.partitionBy(key).orderBy("at")
    news = changes.withColumn("_before", F.lag("value").over(order)).withColumn("_first", F.row_number().over(order) == 1)
    news = news.filter(F.when(F.col("_first"), F.col("value").isNotNull()).otherwise(~F.col("value").eqNullSafe(F.col("_before"))))
    ends = news.withColumn("until", F.lead("at").over(order))
    return ends.filter("value is not null").select(key, "value", F.col("at").alias("since"), "until")


def history_of(snapshots: list[tuple[int, DataFrame]], key: str) -> DataFrame:
    """The history of any number of (number, snapshot), each with one row for a key and the same columns."""
    numbers = [n for n, _ in snapshots]
    if sorted(set(numbers)) != numbers:
        raise ValueError("snapshots must be in order and differ in number")
    rows = None
    for n, df in snapshots:
        part = df.select(key, F.lit(n).cast("long").alias("at"), F.struct(*[c for c in df.columns if c != key]).alias("value"))
        rows = part if rows is None else rows.unionByName(part)
    # A key that a snapshot lacks, after one that has it, ends there: the snapshots that a key has tell which it lacks.
    held = rows.groupBy(key).agg(F.collect_set("at").alias("_held"))
    gone = held.select(key, F.explode(F.array_except(F.array(*[F.lit(n).cast("long") for n in numbers]), "_held")).alias("at"))
    return folded(rows.unionByName(gone.withColumn("value", F.lit(None).cast(rows.schema["value"].dataType))), key)


def as_of(history: DataFrame, at: int) -> DataFrame:
    """The snapshot of a number, or the last one before it, with its columns."""
    holds = (F.col("since") <= at) & (F.col("until").isNull() | (F.col("until") > at))
    return history.filter(holds).select(*[c for c in history.columns if c not in ("value", "since", "until", "part")], "value.*")


class HistoryTable:
    """A history at a path, in parts by key; a new snapshot rewrites only parts that hold a key that changed."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: StructType | None = None) -> None:
        self.spark, self.path, self.key, self.schema = spark, path, key, schema

    def create(self, history: DataFrame) -> None:
        """Write the whole history; whatever stood there goes."""
        rows = history.withColumn("part", _part(self.key))
        self.schema = rows.schema
        self._written(rows, "static")

    def read(self) -> DataFrame:
        return (self.spark.read.schema(self.schema) if self.schema else self.spark.read).parquet(self.path)

    def _written(self, rows: DataFrame, mode: str) -> None:
        rows.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("part").parquet(self.path)

    def merge(self, at: int, snapshot: DataFrame) -> int:
        """Add a snapshot later than all before; how many parts were written anew. Adding it once more changes nothing.

        Open states meet the snapshot by key. Where they differ the open one ends and the new one begins, and the parts of
        those keys are written anew, by dynamic overwrite; no other part is read whole or written.
        """
        key, table = self.key, self.read()
        value = F.struct(*[c for c in snapshot.columns if c != key])
        latest = table.agg(F.max(F.greatest("since", "until"))).first()[0]
        if latest is not None and latest > at:
            raise ValueError(f"the history goes up to {latest}")
        now = snapshot.select(F.col(key).alias("_key"), value.alias("_now"))
        open_now = table.filter(F.col("until").isNull() & (F.col("since") < at)).select(key, F.col("value").alias("_was"))
        begun = table.filter(F.col("since") == at).select(F.col(key).alias("_begun"))
        both = open_now.join(now, F.col(key).eqNullSafe(F.col("_key")), "full_outer").filter(~F.col("_was").eqNullSafe(F.col("_now")))
        both = both.select(F.when(F.col("_now").isNotNull(), F.col("_key")).otherwise(F.col(key)).alias(key), "_now", F.col("_was").isNotNull().alias("_ends"))
        both = both.join(begun, F.col(key).eqNullSafe(F.col("_begun")), "left_anti")
        changed = stored(both.withColumn("part", _part(key)), "changed")
        parts = [r["part"] for r in changed.select("part").distinct().collect()]  # at most PARTS numbers
        if not parts:
            return 0
        touched = table.filter(F.col("part").isin(parts))
        ends = changed.filter("_ends").select(F.col(key).alias("_end"))
        closing = touched.join(ends.withColumn("_closes", F.lit(True)), F.col(key).eqNullSafe(F.col("_end")) & F.col("until").isNull(), "left")
        closing = closing.withColumn("until", F.when(F.col("_closes"), F.lit(at).cast("long")).otherwise(F.col("until")))
        news = changed.filter("_now is not null").select(key, F.col("_now").alias("value"), F.lit(at).cast("long").alias("since"), F.lit(None).cast("long").alias("until"), "part")
        # The parts are read whole before they are overwritten, so that a failed write loses nothing.
        self._written(stored(closing.select(*news.columns).unionByName(news), "touched"), "dynamic")
        return len(parts)


#: lgK of a HyperLogLog sketch, of 2^12 registers: its standard error is 1.04 / 64, 1.7 in a hundred.
HLL_SIZE = 12
#: Size of a quantile sketch; ranks are off by less than 1.7 in a hundred, with 99 in a hundred certainty.
KLL_SIZE = 200


def daily_sketches(rows: DataFrame, day: Column, group: str, org: str, value: str) -> DataFrame:
    """day, group, n, orgs, values: rows of a day with the state of a distinct count and of quantiles; null values have no rank."""
    return rows.groupBy(day.alias("day"), group).agg(
        F.count(F.lit(1)).alias("n"),
        F.hll_sketch_agg(F.col(org), F.lit(HLL_SIZE)).alias("orgs"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), KLL_SIZE).alias("values"),
    )


def merged_figures(sketches: DataFrame, period: Column, group: str, ranks: tuple[float, ...]) -> DataFrame:
    """period, group, n, orgs (estimate), and quantiles q0, q1, ... (estimates) from stored daily states, no row read again."""
    merged = sketches.groupBy(period.alias("period"), group).agg(F.sum("n").alias("n"), F.hll_union_agg("orgs").alias("_orgs"), F.kll_merge_agg_double("values").alias("_values"))
    quantiles = [F.kll_sketch_get_quantile_double("_values", F.lit(r)).alias(f"q{i}") for i, r in enumerate(ranks)]
    return merged.select("period", group, "n", F.hll_sketch_estimate("_orgs").alias("orgs"), *quantiles)
