"""Joins on time: the latest row before each row, and all rows within an interval, without comparing all pairs of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Stretches of time that a bound is cut into, so that a hot key's rows spread over tasks.
SLICES = 16


def micros(time: str | Column) -> Column:
    return F.unix_micros((F.col(time) if isinstance(time, str) else time).cast("timestamp"))


def asof_join(left: DataFrame, right: DataFrame, key: str, time: str, within: float, order: str, name: str = "match", slices: int = SLICES) -> DataFrame:
    """``left`` with a column ``name``: the latest row of ``right`` of its key, at its time or up to ``within`` seconds before.

    ``match`` is null where there is none; of rows of one time the greatest ``order`` is the latest. Rows are dealt by key and
    slice of time: a window finds the latest row in a row's own slice, and the last row of each slice, of which there is
    one, is handed on to the slices within the bound. Rows without key or time match nothing and stay.
    """
    bound = int(within * 1_000_000)
    width = max(1, -(-bound // slices))
    reach = -(-bound // width)
    place = lambda df: df.withColumn("_at", micros(time)).withColumn("_slice", F.expr(f"cast(floor(_at / {width}) as bigint)"))
    packed = F.struct("_at", F.col(order).alias("_order"), F.struct(*right.columns).alias("_row"))
    known = place(right).filter(F.col(key).isNotNull() & F.col("_at").isNotNull()).select(key, "_slice", "_at", packed.alias("_right"))
    rows = place(left).withColumn("_left", F.struct(*left.columns))
    whole = F.col(key).isNotNull() & F.col("_at").isNotNull()
    both = rows.filter(whole).select(key, "_slice", "_at", "_left", F.lit(None).cast(known.schema["_right"].dataType).alias("_right"))
    both = both.unionByName(known.withColumn("_left", F.lit(None).cast(rows.schema["_left"].dataType)))
    # Of one time rows of the right come first, by their order.
    upto = Window.partitionBy(key, "_slice").orderBy("_at", F.col("_left").isNotNull(), F.col("_right._order")).rowsBetween(Window.unboundedPreceding, 0)
    own = both.withColumn("_own", F.last("_right", ignorenulls=True).over(upto)).filter("_left is not null")
    lasts = known.groupBy(key, "_slice").agg(F.max_by("_right", F.struct("_at", "_right._order")).alias("_right"))
    handed = lasts.withColumn("_slice", F.explode(F.transform(F.sequence(F.lit(1), F.lit(reach)), lambda j: F.col("_slice") + j)))
    handed = handed.groupBy(key, "_slice").agg(F.max_by("_right", F.struct("_right._at", "_right._order")).alias("_before"))
    found = own.join(handed, [key, "_slice"], "left").withColumn("_found", F.coalesce("_own", "_before"))
    match = F.when(F.col("_at") - F.col("_found._at") <= bound, F.col("_found._row"))
    lone = rows.filter(~whole).select("_left.*", F.lit(None).cast(known.schema["_right"].dataType["_row"].dataType).alias(name))
    return found.select("_left.*", match.alias(name)).unionByName(lone)


def interval_join(left: DataFrame, right: DataFrame, key: str, time: str, before: float, after: float, slices: int = 1) -> DataFrame:
    """left, right: structs of all pairs of one key in which right's time is from ``before`` seconds before left's to ``after`` after it.

    Right's rows stand in one slice of time each, left's in the slices that their interval touches, which are slices + 1 at
    most; only rows of one key and slice meet. More slices deal a hot key's rows over more tasks. Rows without key or
    time have no pairs.
    """
    low, high = int(before * 1_000_000), int(after * 1_000_000)
    width = max(1, -(-(low + high) // slices))
    slot = lambda at: F.floor(at / width).cast("long")
    a = left.select(F.col(key).alias("_key"), micros(time).alias("_a"), F.struct(*left.columns).alias("left")).filter("_a is not null")
    a = a.withColumn("_slice", F.explode(F.sequence(slot(F.col("_a") - low), slot(F.col("_a") + high))))
    b = right.select(F.col(key).alias("_key"), micros(time).alias("_b"), F.struct(*right.columns).alias("right")).withColumn("_slice", slot(F.col("_b")))
    pairs = a.join(b, ["_key", "_slice"]).filter((F.col("_b") >= F.col("_a") - low) & (F.col("_b") <= F.col("_a") + high))
    return pairs.select("left", "right")


def sessions(events: DataFrame, key: str, time: str, gap: float) -> DataFrame:
    """key, first, last (microseconds), n: a key's rows, each at most ``gap`` seconds after the row before it.

    Rows of one stretch of the gap's length are of one session and are counted before the shuffle, so that a hot key
    sends a row for each stretch and task; only those are brought into order. Rows without time are left out, a null key is a key.
    """
    limit = int(gap * 1_000_000)
    rows = events.select(F.col(key).alias("key"), micros(time).alias("at")).filter("at is not null")
    stretch = F.expr(f"cast(floor(at / {max(1, limit)}) as bigint)").alias("stretch")
    runs = rows.groupBy("key", stretch).agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count(F.lit(1)).alias("n"))
    return merged_sessions(runs.select("key", "first", "last", "n"), gap)


def merged_sessions(runs: DataFrame, gap: float) -> DataFrame:
    """key, first, last, n: runs (the same columns) that overlap or are at most ``gap`` seconds apart as one."""
    limit = int(gap * 1_000_000)
    order = Window.partitionBy("key").orderBy("first", "last")
    upto = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(upto.isNull() | (F.col("first") - upto > limit), 1).otherwise(0)
    numbered = runs.withColumn("_opens", opens).withColumn("_session", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("key", "_session").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n")).drop("_session")
