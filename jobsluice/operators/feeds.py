"""Routing of postings to feeds, and the feeds' figures."""

from __future__ import annotations

import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsluice.sources.work import dropped, stored


class Feed(NamedTuple):
    """A feed's condition: language and tag (null: any), least length and the one beyond, first day and the one after the
    last (null: open), and most rows."""

    feed: str
    lang: str | None
    tag: str | None
    low: int
    high: int
    since: datetime.date | None
    until: datetime.date | None
    most: int


def feeds_of(table: DataFrame) -> list[Feed]:
    """Feeds of a table with Feed's columns, by name. The table is configuration and read whole."""
    return [Feed(*r) for r in table.select(*Feed._fields).orderBy("feed").collect()]


def route(rows: DataFrame, feeds: list[Feed], lang: Column, tags: Column, size: Column, day: Column, order: list[str]) -> DataFrame:
    """feed, rank and the row's columns: each row in every feed it satisfies, the first ``most`` by ``order``.

    Feeds are conditions of the scan; a row is exploded to those it satisfies, and ranks are limited before the shuffle.
    """
    fits = []
    for f in feeds:
        hold = (size >= f.low) & (size < f.high)
        hold = hold & (lang == f.lang) if f.lang else hold
        hold = hold & F.array_contains(tags, f.tag) if f.tag else hold
        hold = hold & (day >= F.lit(f.since)) if f.since else hold
        hold = hold & (day < F.lit(f.until)) if f.until else hold
        fits.append(F.when(hold, F.struct(F.lit(f.feed).alias("feed"), F.lit(f.most).alias("most"))))
    found = F.filter(F.array(*fits), lambda x: x.isNotNull())
    routed = rows.withColumn("_f", F.explode(found)).select("_f.feed", "_f.most", *rows.columns)
    ranked = routed.withColumn("rank", F.row_number().over(Window.partitionBy("feed").orderBy(*order)).cast("long"))
    return ranked.filter((F.col("rank") <= max(f.most for f in feeds)) & (F.col("rank") <= F.col("most"))).drop("most")


#: Feeds' blocks are broadcast up to this many, counted before, and so are the levels that feeds ask for; beyond it they are joined by a shuffle.
BROADCAST_FEEDS = 100_000

KEYS = ["lang_key", "tag_key", "size_level", "size_block", "day_level", "day_block"]


def _exactly(value: Column) -> Column:
    return F.when(value.isNull(), "*").otherwise(F.concat(F.lit("="), value))


def _block(value: Column, level: Column) -> Column:
    """The block of 2^level whole numbers, counted from zero, that a value is in."""
    return F.call_function("shiftright", value, level)


def _blocks(low: Column, high: Column) -> Column:
    """level and block of the fewest blocks that make up the whole numbers from ``low`` up to ``high``, which are not null: two of a level at most."""

    def of(level: Column) -> Column:
        start, last = _block(low, level), _block(high, level)
        first = start + F.when(F.call_function("shiftleft", start, level) == low, 0).otherwise(1)
        odd = lambda x: (first < last) & (x.bitwiseAND(F.lit(1)) == 1)
        return F.array(*[F.when(odd(x), F.struct(level.alias("level"), y.alias("block"))) for x, y in ((first, first), (last, last - 1))])

    # A width that no long can hold takes all levels.
    top = F.coalesce(F.length(F.bin(F.try_subtract(high, low))) - 1, F.lit(63))
    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), top), of)))


def _periods(table: DataFrame, days: DataFrame) -> tuple[DataFrame, int]:
    """How many of the feeds' first and last days are not after a day, as ``_day`` and ``_period``, for these and ``days``; their number. One task sees each day once."""
    edges = table.select(F.explode(F.array("since", "until")).alias("_day")).filter("_day is not null").distinct()
    known = edges.withColumn("_edge", F.lit(1)).unionByName(days.filter("_day is not null").distinct().withColumn("_edge", F.lit(0)))
    known = known.groupBy("_day").agg(F.max("_edge").alias("_edge"))
    return known.select("_day", F.sum("_edge").over(Window.orderBy("_day")).alias("_period")), edges.count()


def feed_index(table: DataFrame, periods: DataFrame, n_edges: int) -> DataFrame:
    """Feeds of a table with Feed's columns by what a row can be looked up with (KEYS): ``lang_key``, ``tag_key`` (``*``: any), a block of sizes and a block of
    periods (level -1: any day or none). A row is in one block of a feed at most. ``limit`` is the last rank that any feed of the name asks for."""
    limit = F.max("most").over(Window.partitionBy("feed"))
    given = table.withColumn("limit", limit).filter("low < high and limit > 0")
    for c in ("since", "until"):
        given = given.join(F.broadcast(periods.select(F.col("_day").alias(c), F.col("_period").alias(f"_{c}"))), c, "left")
    any_day = F.array(F.struct(F.lit(-1).alias("level"), F.lit(0).cast("long").alias("block")))
    within = _blocks(F.coalesce("_since", F.lit(0).cast("long")), F.coalesce("_until", F.lit(1 << n_edges.bit_length()).cast("long")))
    sizes = _blocks(F.col("low").cast("long"), F.col("high").cast("long"))
    given = given.select(
        _exactly(F.col("lang")).alias("lang_key"), _exactly(F.col("tag")).alias("tag_key"), "feed", "most", "limit",
        F.explode(sizes).alias("_size"), F.when(F.col("since").isNull() & F.col("until").isNull(), any_day).otherwise(within).alias("_days"),
    )
    given = given.withColumn("_day", F.explode("_days"))
    return given.select("lang_key", "tag_key", *[F.col(f"_{of}.{c}").alias(f"{of}_{c}") for of in ("size", "day") for c in ("level", "block")], "feed", "most", "limit")


def _dealt(many: DataFrame, few: DataFrame, keys: list[str], by: list[Column]) -> DataFrame:
    """Both tables joined by a shuffle; a key with more than its share of ``many`` is dealt in parts, each with a copy of its rows of ``few``."""
    parts = int(many.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = stored(many.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "feed-keys")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # Fewer keys than parts hold more than one in so many of the rows.
    hot = stored(counts.filter(F.col("n") * parts > total).select(*keys, F.ceil(F.col("n") * parts / max(total, 1)).cast("int").alias("_parts")), "hot-keys")
    dropped(counts)
    dealt = many.join(F.broadcast(hot), keys, "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64(*by), F.col("_parts")).cast("int"), F.lit(0))).drop("_parts")
    copies = few.join(F.broadcast(hot), keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return dealt.join(copies, [*keys, "_part"])


def route_table(rows: DataFrame, table: DataFrame, lang: Column, tags: Column, size: Column, day: Column, order: list[str], most_broadcast: int = BROADCAST_FEEDS) -> DataFrame:
    """The same rows as ``route`` from any number of feeds, which stay a table: no feed is part of the plan.

    A feed's sizes are made up of blocks of 2^k numbers, its days of blocks of 2^k periods between the days that feeds name; a row is
    looked up by its language or any, each of its tags or any, and the blocks it is in on the levels that feeds ask for, so that it meets
    only feeds that it fits. Beyond ``most_broadcast`` rows of the index, rows and feeds are not paired: the first rows of each block are
    found first, as many as any feed takes, and a feed picks its own from those of its blocks. So work grows with rows plus feeds, not
    with their product. Rows are stored then, and travel as a number and ``order`` until they are picked; joins shuffle, and a key with
    more than its share is dealt in parts. The last rank is known to the windows beforehand, so that tasks send no more than that many
    rows of a block or feed. A row without language or tags meets the feeds that ask for none; one without size none, one without
    day those without days. Feeds that are given twice count twice. ``rows`` has none of the columns feed, most, rank.
    """
    most, lowest, beyond = table.filter("low < high").agg(F.coalesce(F.max("most"), F.lit(0)), F.coalesce(F.min("low"), F.lit(0)), F.coalesce(F.max("high"), F.lit(0))).first()
    wanted = lambda values: F.concat(F.array(F.lit("*")), F.transform(F.array_compact(F.array_distinct(F.coalesce(values, F.array().cast("array<string>")))), _exactly))
    held = rows.select(F.struct(*rows.columns).alias("_row"), F.floor(size).cast("long").alias("_size"), day.cast("date").alias("_day"), wanted(F.array(lang)).alias("_langs"), wanted(tags).alias("_tags"))
    held = held.filter((F.col("_size") >= lowest) & (F.col("_size") < beyond))
    periods, n_edges = _periods(table, held.select("_day"))
    index = feed_index(table, periods, n_edges)
    paired = index.count() <= most_broadcast
    if not paired:
        held = stored(held.withColumn("_id", F.monotonically_increasing_id()), "feed-rows")
        periods = stored(_periods(table, held.select("_day"))[0], "feed-periods")
        index = stored(feed_index(table, periods, n_edges), "feed-index")
    found = held if paired else held.select("_id", *[F.col(f"_row.`{c}`").alias(f"_by{k}") for k, c in enumerate(order)], "_size", "_day", "_langs", "_tags")
    found = found.join(F.broadcast(periods), "_day", "left").withColumn("lang_key", F.explode("_langs")).withColumn("tag_key", F.explode("_tags")).drop("_day", "_langs", "_tags")
    levels = index.select("lang_key", "tag_key", "size_level", "day_level").distinct()
    if paired or levels.count() <= most_broadcast:
        found = found.join(F.broadcast(levels), ["lang_key", "tag_key"])
    else:
        found = _dealt(found, levels, ["lang_key", "tag_key"], [F.col("_id")]).drop("_part")
    day_block = F.when(F.col("day_level") < 0, 0).otherwise(_block(F.col("_period"), F.col("day_level")))
    found = found.withColumn("size_block", _block(F.col("_size"), F.col("size_level"))).withColumn("day_block", day_block).filter("day_block is not null").drop("_size", "_period")
    by = order if paired else [f"_by{k}" for k in range(len(order))]
    if paired:
        routed = found.join(F.broadcast(index), KEYS).select("feed", "most", "_row.*")
    else:
        first = found.withColumn("_nth", F.row_number().over(Window.partitionBy("size_block", *[k for k in KEYS if k != "size_block"]).orderBy(*by))).filter(F.col("_nth") <= most)
        routed = _dealt(index, first, KEYS, [F.col("feed")]).filter("_nth <= limit").select("feed", "most", "_id", *by)
    ranked = routed.withColumn("rank", F.row_number().over(Window.partitionBy("feed").orderBy(*by)).cast("int"))
    ranked = ranked.filter((F.col("rank") <= most) & (F.col("rank") <= F.col("most"))).withColumn("rank", F.col("rank").cast("long")).drop("most")
    return ranked if paired else ranked.join(held.select("_id", "_row"), "_id").select("feed", "_row.*", "rank")


def feed_stats(rows: DataFrame, levels: list[str], org: str, day: str) -> DataFrame:
    """Rows, newest day and distinct organisations by each level and above it, with the level's grouping id."""
    return rows.rollup(*levels).agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n"), F.max(day).alias("newest"), F.count_distinct(org).alias("n_orgs"))
