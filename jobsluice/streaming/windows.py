"""Streams whose windows are tables: sliding windows with late rows counted, sessions that merge, pairs within a bound.

State is a table for each batch, in a folder that the driver and all executors share. A batch reads what the batches
before it wrote and overwrites what it writes itself, so that one that is run again after a failure changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsluice.operators.timejoin import merged_sessions, micros, sessions
from jobsluice.streaming.intake import run_each

MARKS, SESSIONS = "at long, batch long", "key {kind}, first long, last long, n long, batch long"


def watermark_before(spark: SparkSession, path: str, number: int, delay: int) -> int | None:
    """The latest time of the batches before this one, less the delay; None before the first."""
    if number == 0:
        return None
    latest = spark.read.schema(MARKS).parquet(f"{path}/marks").filter(F.col("batch") < number).agg(F.max("at")).first()[0]
    return None if latest is None else latest - delay


def sliding_windows(events: DataFrame, key: str, time: str, value: str, width: float, slide: float, delay: float, path: str, checkpoint: str) -> None:
    """Counts and sums of ``value`` in overlapping windows by key, and what came too late for each window.

    A row stands in each of the width / slide windows that hold it. It is late for those whose end the watermark, the
    latest time of the batches before less ``delay`` seconds, has reached; these are counted apart, so that windows and late
    rows together are all rows. Rows without time are left out. Read the results with sliding_results.
    """
    span, step, late_by = (int(x * 1_000_000) for x in (width, slide, delay))
    if span % step:
        raise ValueError("the width must be a multiple of the slide")

    def handle(batch: DataFrame, number: int) -> None:
        mark = watermark_before(batch.sparkSession, path, number, late_by)
        rows = batch.select(F.col(key).alias("key"), micros(time).alias("at"), F.col(value).cast("double").alias("value")).filter("at is not null")
        last = F.floor(F.col("at") / step).cast("long") * step
        placed = rows.withColumn("start", F.explode(F.sequence(last - span + step, last, F.lit(step).cast("long"))))
        late = F.lit(False) if mark is None else F.col("start") + span <= mark
        parts = placed.groupBy("key", "start", late.alias("late")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
        parts.write.mode("overwrite").parquet(f"{path}/parts/batch={number}")
        rows.agg(F.max("at").alias("at")).write.mode("overwrite").parquet(f"{path}/marks/batch={number}")

    run_each(events, handle, checkpoint)


def sliding_results(spark: SparkSession, path: str, key_type: str = "string") -> DataFrame:
    """key, start (microseconds), late, n, total over all batches; null keys are a key."""
    parts = spark.read.schema(f"key {key_type}, start long, late boolean, n long, total double, batch long").parquet(f"{path}/parts")
    return parts.groupBy("key", "start", "late").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def session_stream(events: DataFrame, key: str, time: str, gap: float, delay: float, path: str, checkpoint: str) -> None:
    """Sessions by key, kept open until the watermark has passed their last row by ``gap`` seconds.

    A batch's rows are sessions of their own first and then merge with the open ones that they touch, which may make one of
    several. Rows before the watermark (the latest time of the batches before, less ``delay`` seconds) are late: they are
    counted by key apart and left out. Read the results with session_results.
    """
    limit, late_by = int(gap * 1_000_000), int(delay * 1_000_000)
    kind = events.schema[key].dataType.simpleString()

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        mark = watermark_before(spark, path, number, late_by)
        rows = batch.select(F.col(key).alias("key"), F.col(time).alias("time"), micros(time).alias("at")).filter("at is not null")
        late = F.lit(False) if mark is None else F.col("at") < mark
        runs = sessions(rows.filter(~late), "key", "time", gap)
        if number:
            before = spark.read.schema(SESSIONS.format(kind=kind)).parquet(f"{path}/open").filter(F.col("batch") == number - 1)
            runs = merged_sessions(runs.unionByName(before.drop("batch")), gap)
        rows.agg(F.max("at").alias("at")).write.mode("overwrite").parquet(f"{path}/marks/batch={number}")
        rows.filter(late).groupBy("key").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/late/batch={number}")
        after = watermark_before(spark, path, number + 1, late_by)
        runs = runs.withColumn("closed", F.lit(False) if after is None else F.col("last") + limit < after)
        runs.filter("closed").drop("closed").write.mode("overwrite").parquet(f"{path}/closed/batch={number}")
        runs.filter("not closed").drop("closed").write.mode("overwrite").parquet(f"{path}/open/batch={number}")

    run_each(events, handle, checkpoint)


def session_results(spark: SparkSession, path: str, key_type: str) -> DataFrame:
    """key, first, last, n, closed: all sessions, those still open after the last batch too."""
    read = lambda name: spark.read.schema(SESSIONS.format(kind=key_type)).parquet(f"{path}/{name}")
    newest = spark.read.schema(MARKS).parquet(f"{path}/marks").agg(F.max("batch")).first()[0]
    open_now = read("open").filter(F.col("batch") == newest).drop("batch")
    return read("closed").drop("batch").withColumn("closed", F.lit(True)).unionByName(open_now.withColumn("closed", F.lit(False)))


def paired_streams(left: DataFrame, right: DataFrame, key: str, time: str, within: float, delay: str) -> DataFrame:
    """A stream of left's columns with the struct ``pair`` of each row of ``right`` of its key up to ``within`` seconds before it.

    A row without any comes with a null pair once both watermarks show that none can follow; rows later than ``delay`` are
    left out. Both sides are kept in Spark's join state as long as they can still be paired.
    """
    at = lambda df, name: df.withColumn(name, F.col(time).cast("timestamp")).withWatermark(name, delay)
    a = at(left, "_left_at")
    b = at(right.select(F.struct(*right.columns).alias("pair"), time, F.col(key).alias("_right_key")), "_right_at").drop(time)
    bound = F.expr(f"INTERVAL {int(within * 1_000_000)} MICROSECONDS") if within < 1 else F.expr(f"INTERVAL {int(within)} SECONDS")
    same = (F.col(key) == F.col("_right_key")) & (F.col("_right_at") <= F.col("_left_at")) & (F.col("_right_at") >= F.col("_left_at") - bound)
    return a.join(b, same, "left_outer").select(*left.columns, "pair")
