"""Stateful streams: deduplication with expiry and the lifecycle of keys.

A key's state is a row of a table for each batch, as in streaming.windows: Spark sorts a batch's rows, spills them and deals
them by key, and a batch that is run again overwrites what it wrote.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobsluice.operators.timejoin import micros
from jobsluice.streaming.intake import run_each
from jobsluice.streaming.windows import watermark_before


def _in_order() -> Window:
    return Window.partitionBy("key").orderBy("micros", "event_id")


def _batch(batch: DataFrame, key: str, time: str, mark: int | None, *more: str) -> DataFrame:
    """key, micros and more of the batch's rows with a time that is not before the watermark."""
    rows = batch.select(F.col(key).alias("key"), micros(time).alias("micros"), *more).filter("micros is not null")
    return rows if mark is None else rows.filter(F.col("micros") >= mark)


def _state(spark: SparkSession, path: str, schema: str, number: int) -> DataFrame:
    """The state after the batch before."""
    if number == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(f"{schema}, batch long").parquet(f"{path}/state").filter(F.col("batch") == number - 1).drop("batch")


def _with_state(rows: DataFrame, state: DataFrame) -> DataFrame:
    same = F.col("key").eqNullSafe(F.col("_state.key"))
    return rows.join(state.select(F.struct(*state.columns).alias("_state")), same, "left")


def _written(df: DataFrame, path: str, name: str, number: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/{name}/batch={number}")


def dedup_with_ttl(events: DataFrame, key: str, time: str, seconds: float, path: str, checkpoint: str, late: float = 60) -> None:
    """Write event_id, key, micros of the rows that pass the gap rule to ``path``/out, a folder for each batch.

    A row passes if its key's row before it is absent or more than ``seconds`` older. Batches must come in the order of
    time; rows without a time and such more than ``late`` seconds behind the batches before are left out. A key's time is kept
    until any row that may still come would pass.
    """
    limit, delay = int(seconds * 1_000_000), int(late * 1_000_000)
    schema = f"key {events.schema[key].dataType.simpleString()}, last long"

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = _batch(batch, key, time, watermark_before(spark, path, number, delay), "event_id")
        state = _state(spark, path, schema, number)
        known = _with_state(rows, state).withColumn("before", F.greatest(F.lag("micros").over(_in_order()), F.col("_state.last")))
        passed = known.filter(F.col("before").isNull() | (F.col("micros") - F.col("before") > limit))
        _written(passed.select("event_id", "key", "micros"), path, "out", number)
        _written(rows.agg(F.max("micros").alias("at")), path, "marks", number)
        after = watermark_before(spark, path, number + 1, delay)
        lasts = state.unionByName(rows.select("key", F.col("micros").alias("last"))).groupBy("key").agg(F.max("last").alias("last"))
        _written(lasts if after is None else lasts.filter(F.col("last") + limit >= after), path, "state", number)

    run_each(events, handle, checkpoint)


def lifecycle_stream(events: DataFrame, key: str, time: str, seconds: float, forget: float, late: float, path: str, checkpoint: str) -> None:
    """Write key, event, micros, n (rows since the key was new) to ``path``/out: one row for each row with a time and each expiry.

    A row is ``seen`` up to ``seconds`` after its key's row before it, then ``back``, and after more than ``forget`` ``new``
    again. A key without rows for longer than ``seconds`` expires: before its next row, or once the watermark has passed. Its
    state goes once the watermark has passed ``forget``, after which any row is new by the same rule. The same whatever the
    batches, if they come in the order of time; rows more than ``late`` seconds behind the batches before are left out.
    """
    limit, gone, delay = (int(x * 1_000_000) for x in (seconds, forget, late))
    schema = f"key {events.schema[key].dataType.simpleString()}, last long, n long, expired boolean"

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = _batch(batch, key, time, watermark_before(spark, path, number, delay)).withColumn("event_id", F.lit(0))
        state = _state(spark, path, schema, number)
        order = _in_order()
        known = _with_state(rows, state).withColumn("before", F.coalesce(F.lag("micros").over(order), F.col("_state.last"))).withColumn("place", F.row_number().over(order))
        gap = F.col("micros") - F.col("before")
        known = known.withColumn("event", F.when(gap.isNull() | (gap > gone), "new").when(gap > limit, "back").otherwise("seen"))
        lives = known.withColumn("life", F.sum((F.col("event") == "new").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        held = F.when(F.col("life") == 0, F.col("_state.n")).otherwise(0)
        told = lives.withColumn("n", held + F.row_number().over(Window.partitionBy("key", "life").orderBy("place")))
        told = told.withColumn("n_before", F.coalesce(F.lag("n").over(Window.partitionBy("key").orderBy("place")), F.col("_state.n")))
        ends = told.filter((gap > limit) & ~((F.col("place") == 1) & F.coalesce("_state.expired", F.lit(False))))
        _written(rows.agg(F.max("micros").alias("at")), path, "marks", number)
        after = watermark_before(spark, path, number + 1, delay)
        latest = told.groupBy("key").agg(F.max_by(F.struct("micros", "n"), "place").alias("_last"))
        latest = latest.select("key", F.struct(F.col("_last.micros").alias("last"), F.col("_last.n").alias("n")).alias("_new"))
        both = _merged(state, latest)
        silent = F.lit(False) if after is None else ~F.col("expired") & (F.col("last") + limit < after)
        both = both.withColumn("expires", silent)
        event = lambda df, name, at, n: df.select("key", F.lit(name).alias("event") if isinstance(name, str) else name, at.alias("micros"), n.alias("n"))
        out = event(told, F.col("event"), F.col("micros"), F.col("n"))
        out = out.unionByName(event(ends, "expired", F.col("before") + limit, F.col("n_before"))).unionByName(event(both.filter("expires"), "expired", F.col("last") + limit, F.col("n")))
        _written(out, path, "out", number)
        kept = both if after is None else both.filter(F.col("last") + gone >= after)
        _written(kept.select("key", "last", "n", (F.col("expired") | F.col("expires")).alias("expired")), path, "state", number)

    run_each(events, handle, checkpoint)


def _merged(state: DataFrame, latest: DataFrame) -> DataFrame:
    """The state with the keys of the batch renewed; a late row does not set a key back."""
    old = state.select(F.col("key").alias("_key"), F.struct("last", "n", "expired").alias("_old"))
    both = old.join(latest, F.col("_key").eqNullSafe(F.col("key")), "full_outer")
    renewed: Column = F.col("_new").isNotNull()
    return both.select(
        F.when(renewed, F.col("key")).otherwise(F.col("_key")).alias("key"),
        F.greatest("_old.last", "_new.last").alias("last"),
        F.when(renewed, F.col("_new.n")).otherwise(F.col("_old.n")).alias("n"),
        F.when(renewed, False).otherwise(F.col("_old.expired")).alias("expired"),
    )


def health_stream(events: DataFrame, source: str, window: str, late: str) -> DataFrame:
    """start, source, n, total by tumbling windows; in append mode a window comes out when the watermark has passed it."""
    rows = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return rows.groupBy(F.window("at", window).alias("w"), source).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), source, "n", "total")
