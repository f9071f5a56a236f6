"""Streams over the events table, run to what is available; their results are read back as tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsluice.plans.registry import register
from jobsluice.plans.time_queries import SESSIONS_SQL
from jobsluice.sources.tables import table
from jobsluice.sources.work import shared_dir
from jobsluice.streaming.intake import new_rows, run_available, run_each
from jobsluice.streaming.windows import paired_streams, session_results, session_stream, sliding_results, sliding_windows
from jobsluice.streaming.stateful import dedup_with_ttl, health_stream, lifecycle_stream

def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return new_rows(spark, f"{sf_dir.rstrip('/')}/events*.parquet", schema)  # a pattern: a stream reads folders or patterns


@register("b2_stream_ttl", """SELECT event_id, user_id AS key, epoch_us(ts) AS micros FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
    WHERE p IS NULL OR epoch_us(ts) - epoch_us(p) > 7 * 86400 * 1000000::BIGINT""")
def b2_stream_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = shared_dir(spark, "stream")
    dedup_with_ttl(_events(spark, sf_dir), "user_id", "ts", 7 * 86400, f"{work}/kept", f"{work}/checkpoint")
    return spark.read.schema("event_id long, key long, micros long").parquet(f"{work}/kept/out").select("event_id", "key", "micros")


def _lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events of the lifecycle: keys expire after 7 days, are forgotten after 28, rows may be a minute late."""
    work = shared_dir(spark, "stream")
    lifecycle_stream(_events(spark, sf_dir), "user_id", "ts", 7 * 86400, 28 * 86400, 60, f"{work}/kept", f"{work}/checkpoint")
    return spark.read.schema("key long, event string, micros long, n long").parquet(f"{work}/kept/out").select("key", "event", "micros", "n")


@register("b21_lifecycle", "SELECT user_id AS key, 'new' AS event, max(epoch_us(ts)) AS micros, count(*) AS n FROM events GROUP BY user_id")
def b21_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary of the events: each key's first, the time of its latest row and its rows."""
    rows = _lifecycle(spark, sf_dir).filter("event <> 'expired'")
    return rows.groupBy("key").agg(F.min_by("event", F.struct("micros", "n")).alias("event"), F.max("micros").alias("micros"), F.count(F.lit(1)).alias("n"))


@register("b21_lifecycle_events", """WITH g AS (SELECT user_id AS key, epoch_us(ts) AS t, lag(epoch_us(ts)) OVER w AS p, lead(epoch_us(ts)) OVER w AS q FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    r AS (SELECT *, sum(CASE WHEN p IS NULL OR t - p > 28 * 86400 * 1000000::BIGINT THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY t, p NULLS FIRST ROWS UNBOUNDED PRECEDING) AS life FROM g),
    c AS (SELECT *, row_number() OVER (PARTITION BY key, life ORDER BY t, p NULLS FIRST) AS n FROM r)
    SELECT key, CASE WHEN p IS NULL OR t - p > 28 * 86400 * 1000000::BIGINT THEN 'new' WHEN t - p > 7 * 86400 * 1000000::BIGINT THEN 'back' ELSE 'seen' END AS event, t AS micros, n FROM c
    UNION ALL SELECT key, 'expired', t + 7 * 86400 * 1000000::BIGINT, n FROM c
    WHERE coalesce(q, (SELECT max(epoch_us(ts)) - 60 * 1000000::BIGINT FROM events)) - t > 7 * 86400 * 1000000::BIGINT""")
def b21_lifecycle_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lifecycle(spark, sf_dir)


@register("b24_stream_health", "SELECT date_trunc('day', ts)::DATE AS day, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def b24_stream_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every window, open ones too: each batch gives its changed windows, and a window's last figures hold."""
    work = shared_dir(spark, "stream")

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{work}/out/number={number}")

    run_each(health_stream(_events(spark, sf_dir), "event_type", "1 day", "2 days"), keep, f"{work}/checkpoint")
    rows = spark.read.parquet(f"{work}/out")
    last = rows.groupBy("start", "event_type").agg(F.max_by(F.struct("n", "total"), "batch").alias("v"))
    return last.select(F.col("start").cast("date").alias("day"), "event_type", "v.n", F.round("v.total", 2).alias("total"))


@register("b32_intake", "SELECT event_type, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY event_type")
def b32_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = shared_dir(spark, "stream")
    rows = _events(spark, sf_dir).select("event_id", "event_type")
    for _ in range(2):  # the second run finds nothing new
        run_available(rows, f"{work}/out", f"{work}/checkpoint")
    return spark.read.schema("event_id long, event_type string").parquet(f"{work}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


def _in_slices(spark: SparkSession, rows: DataFrame, work: str, slice_of: Column, n: int, run: Callable[[DataFrame], None]) -> None:
    """Lands the rows slice by slice, and runs the stream anew after each."""
    schema = rows.schema
    for k in range(n):
        rows.filter(slice_of == k).write.mode("append").parquet(f"{work}/in")
        run(new_rows(spark, f"{work}/in", schema))


@register("b24_sliding_late", """WITH e AS (SELECT event_type, value, epoch_us(ts) AS t, least(3, (day(ts) - 1) // 8 + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) AS slice FROM events),
    m AS (SELECT slice, (SELECT max(t) FROM e b WHERE b.slice < a.slice) - 2 * 3600 * 1000000::BIGINT AS mark FROM (SELECT DISTINCT slice FROM e) a),
    w AS (SELECT event_type, value, slice, (t // (6 * 3600 * 1000000::BIGINT) - unnest([0, 1, 2, 3])) * 6 * 3600 * 1000000::BIGINT AS start FROM e)
    SELECT event_type, start, coalesce(start + 86400 * 1000000::BIGINT <= mark, false) AS late, count(*) AS n, round(sum(value), 2) AS total FROM w JOIN m USING (slice) GROUP BY ALL""")
def b24_sliding_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that slide by six hours, over events of which every seventh comes a quarter of a month late."""
    work = shared_dir(spark, "stream")
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    quarter = F.floor((F.dayofmonth("ts") - 1) / 8)
    run = lambda stream: sliding_windows(stream, "event_type", "ts", "value", 86400, 6 * 3600, 2 * 3600, f"{work}/out", f"{work}/checkpoint")
    _in_slices(spark, rows, work, F.least(F.lit(3), quarter + (F.col("event_id") % 7 == 0).cast("int")), 4, run)
    return sliding_results(spark, f"{work}/out").select(F.col("key").alias("event_type"), "start", "late", "n", F.round("total", 2).alias("total"))


@register("b24_stream_sessions", SESSIONS_SQL)
def b24_stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sessions of b24_sessions from a stream that comes in four parts, open ones included."""
    work = shared_dir(spark, "stream")
    rows = table(spark, sf_dir, "events").select("user_id", "ts")
    _in_slices(spark, rows, work, F.floor((F.dayofmonth("ts") - 1) / 8), 4, lambda s: session_stream(s, "user_id", "ts", 86400, 3600, f"{work}/out", f"{work}/checkpoint"))
    return session_results(spark, f"{work}/out", "bigint").select(F.col("key").alias("user_id"), "first", "last", "n")


@register("b24_stream_pairs", """SELECT p.event_id, c.event_id AS click_id FROM (FROM events WHERE event_type = 'purchase') p
    LEFT JOIN (FROM events WHERE event_type = 'click') c ON c.user_id = p.user_id AND epoch_us(p.ts) - epoch_us(c.ts) BETWEEN 0 AND 6 * 3600 * 1000000::BIGINT""")
def b24_stream_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as a stream with the clicks of six hours before, from another stream; those without any, too.

    The last slice is one row a year later on each side, which lets the watermark pass all others.
    """
    work = shared_dir(spark, "stream")
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    end = rows.agg((F.max("ts") + F.expr("INTERVAL 1 YEAR")).alias("ts")).filter("ts is not null")
    ends = end.select(F.lit(None).cast("long").alias("event_id"), "ts", F.explode(F.array(F.lit("purchase"), F.lit("click"))).alias("event_type"))
    ends = ends.withColumn("user_id", F.when(F.col("event_type") == "click", -1).cast("long"))  # Spark drops a click without a user before it counts for the watermark
    quarter = F.floor((F.dayofmonth("ts") - 1) / 8)

    def run(stream: DataFrame) -> None:
        of = lambda kind: stream.filter(F.col("event_type") == kind).drop("event_type")
        run_available(paired_streams(of("purchase"), of("click"), "user_id", "ts", 6 * 3600, "1 hour"), f"{work}/out", f"{work}/checkpoint")

    _in_slices(spark, rows.unionByName(ends), work, F.when(F.col("event_id").isNull(), 4).otherwise(quarter), 5, run)
    out = spark.read.schema("event_id long, user_id long, ts timestamp_ntz, pair struct<event_id: long, user_id: long, ts: timestamp_ntz>").parquet(f"{work}/out")
    return out.filter("event_id is not null").select("event_id", F.col("pair.event_id").alias("click_id"))
