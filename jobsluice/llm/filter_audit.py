"""Filter interaction audit: what each filter removes in every order, from one table of failing ids for each filter."""

from __future__ import annotations

import json
from itertools import combinations, permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from jobsluice.llm.common import dropped, join_counted, read, stored, text_of
from jobsluice.sources.work import shared_dir

#: All orders are reported, which are 5,040 for so many filters.
MOST_FILTERS = 7
SEPARATORS = " \t\n\x0b\f\r"


def row_failures(text: Column) -> dict[str, Column]:
    """Conditions of a text alone: A under 50 words, B too few distinct words, C too many capitals, D odd signs."""
    words = F.split(F.btrim(text, F.lit(SEPARATORS)), r"[\x20\x09-\x0D]+")
    n = F.when(F.btrim(text, F.lit(SEPARATORS)) == "", 0).otherwise(F.size(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": n < 50,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 65 * n.cast("long"),
        "C": 100 * capitals.cast("long") > 5 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def copies(digests: DataFrame) -> DataFrame:
    """id of the rows (id, sha) of whose digest there is a smaller id.

    Digests are counted before the shuffle; rows of a large group find its smallest id by a broadcast.
    """
    shared = digests.groupBy("sha").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    shared = stored(shared.withColumn("k", F.xxhash64("sha")), "shared")
    total = shared.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    found = join_counted(digests.withColumn("k", F.xxhash64("sha")), shared, ["k", "sha"], "rows", total, ["id"])
    return found.filter(F.col("id") > F.col("first")).select("id")


def failing_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> tuple[DataFrame, dict[str, DataFrame]]:
    """(members: id and part, failing: filter -> stored table of the ids that fail it), for the filters A to E.

    Texts are read once. A document is an id: rows that repeat one are one document, which fails what any of them fails and
    stands in the least of their parts; null ids are one document, which has no smaller id. A null text is empty, a null
    part the empty string. Equal texts are such of equal SHA-256 digests.
    """
    text = text_of(text_col)
    failed = F.array_compact(F.array(*[F.when(hit, F.lit(name)) for name, hit in row_failures(F.col("text")).items()]))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    judged = stored(rows.select("id", "part", failed.alias("failed"), F.unhex(F.sha2("text", 256)).alias("sha")), "judged")
    tables = judged.select("id", F.explode("failed").alias("filter")).unionByName(copies(judged.select("id", "sha")).withColumn("filter", F.lit("E")))
    path = f"{shared_dir(docs.sparkSession, 'audit')}/failing"
    tables.write.option("compression", "zstd").partitionBy("filter").parquet(path)
    listed = docs.sparkSession.read.schema(tables.schema).parquet(path)
    members = judged.groupBy("id").agg(F.min("part").alias("part"))
    return members, {name: listed.filter(F.col("filter") == name).select("id") for name in "ABCDE"}


def _among(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """``rows`` with (left_semi) or without (left_anti) their id in ``ids``; null ids are equal."""
    return rows.join(ids.select(F.col("id").alias("failing id")), F.col("id").eqNullSafe(F.col("failing id")), how)


def failure_classes(members: DataFrame, failing: dict[str, DataFrame], labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """part, failed (array of filters), n, good, toxic: documents of a part that fail the same filters, if any.

    Each filter's id table splits the failing documents into those that it has (left semi) and those that it lacks (left
    anti), so that every document meets every table once, however many orders are asked for.
    """
    listed = None
    for ids in failing.values():
        listed = ids if listed is None else listed.union(ids)
    marks = labels.groupBy(F.col(id_col).alias("id")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    rows = _among(members, listed, "left_semi").join(marks, "id", "left").na.fill(False, ["good", "toxic"]).withColumn("failed", F.array().cast("array<string>"))
    rows = stored(rows, "failing")
    for name, ids in failing.items():
        hit = _among(rows, ids, "left_semi").withColumn("failed", F.concat("failed", F.array(F.lit(name))))
        split = stored(hit.unionByName(_among(rows, ids, "left_anti")), "failing")
        dropped(rows)
        rows = split
    classes = stored(rows.groupBy("part", "failed").agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")), "classes")
    dropped(rows)
    return classes


def prefix_figures(classes: DataFrame, names: list[str]) -> DataFrame:
    """part, gone, filter, removed, redundant, good_lost, toxic_lost: filter's effect after the filters ``gone`` (sorted).

    The figures depend on the set of the filters before, not on their order. Classes that ``gone`` removes and those that
    survive it are told apart by semi and anti joins with the classes failing each filter; all of it are aggregates
    of documents, at most 2^filters rows a part.
    """
    prefixes = [list(c) for n in range(len(names)) for c in combinations(sorted(names), n)]
    literal = lambda value, kind: F.from_json(F.lit(json.dumps(value)), kind)
    known = classes.select("failed").distinct()
    fails = known.select("failed", F.explode("failed").alias("filter"))
    hit = known.select("failed", F.explode(literal(prefixes, "array<array<string>>")).alias("gone")).select("failed", "gone", F.explode("gone").alias("filter"))
    hit = hit.join(fails, ["failed", "filter"], "left_semi").select("failed", "gone").distinct()
    steps = classes.withColumn("gone", F.explode(literal(prefixes, "array<array<string>>")))
    steps = steps.withColumn("filter", F.explode(F.array_except(literal(sorted(names), "array<string>"), "gone")))
    failing = steps.join(fails, ["failed", "filter"], "left_semi")
    survive, fallen = failing.join(hit, ["failed", "gone"], "left_anti"), failing.join(hit, ["failed", "gone"], "left_semi")
    before = steps.join(hit, ["failed", "gone"], "left_semi")
    one = lambda df, **cols: df.select("part", "gone", "filter", *[(F.col(cols[k]) if k in cols else F.lit(0)).cast("long").alias(k) for k in ("before", "removed", "redundant", "good_lost", "toxic_lost")])
    both = one(survive, removed="n", good_lost="good", toxic_lost="toxic").unionByName(one(fallen, redundant="n")).unionByName(one(before, before="n"))
    return both.groupBy("part", "gone", "filter").agg(*[F.sum(c).alias(c) for c in ("before", "removed", "redundant", "good_lost", "toxic_lost")])


def audit(members: DataFrame, failing: dict[str, DataFrame], labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per part, filter_order and step, with zeros; see the columns of op13_filter_audit.

    ``members`` (id, part) has each id once; ``failing`` has one table of ids for each filter, where repeated ids count
    once and ids that are no members nothing. ``labels`` (id_col, quality, toxic) may repeat ids, of which any counts, and
    hold nulls, which say nothing. No members, no rows.
    """
    names = list(failing)
    if not 0 < len(names) <= MOST_FILTERS:
        raise ValueError(f"the orders of 1 to {MOST_FILTERS} filters can be reported")
    members = stored(members.select("id", "part"), "members")
    figures = prefix_figures(failure_classes(members, failing, labels, id_col), names)
    totals = members.groupBy("part").agg(F.count(F.lit(1)).alias("total"))
    orders = [(o, k + 1, o[k], sorted(o[:k])) for o in permutations(names) for k in range(len(names))]
    table = F.from_json(F.lit(json.dumps([{"filter_order": "".join(o), "step": k, "filter": f, "gone": g} for o, k, f, g in orders])), "array<struct<filter_order:string,step:int,filter:string,gone:array<string>>>")
    grid = totals.select("part", "total", F.explode(table).alias("s")).select("part", "total", "s.*")
    counts = ["before", "removed", "redundant", "good_lost", "toxic_lost"]
    rows = grid.join(figures, ["part", "gone", "filter"], "left").na.fill(0, counts)
    own = Window.partitionBy("part", "filter")
    unique = F.max(F.when(F.size("gone") == len(names) - 1, F.col("removed"))).over(own)
    return rows.select(
        "part", "filter_order", "step",
        (F.col("total") - F.col("before") - F.col("removed")).alias("kept"), "removed", "redundant", unique.alias("unique_fails"),
        "good_lost", "toxic_lost", F.sum("removed").over(own).alias("shapley"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, failing = failing_ids(read(spark, sf_dir, "documents"))
    return audit(members, failing, read(spark, sf_dir, "labels"))


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM t),
j AS (SELECT w.doc_id, part, coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic,
    CASE WHEN len(words) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN w.doc_id > first THEN 'E' ELSE '' END AS failed FROM w LEFT JOIN labels l ON l.doc_id = w.doc_id),
c AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM j GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, unnest([1, 2, 3, 4, 5])::INT AS step FROM o),
p AS (SELECT *, substr(filter_order, step, 1) AS flt, '[' || left(filter_order, step - 1) || '_]' AS before, '[' || left(filter_order, step) || ']' AS upto FROM s),
r AS (SELECT part, filter_order, step, any_value(flt) AS flt,
    sum(n) FILTER (NOT regexp_matches(failed, upto)) AS kept,
    sum(n) FILTER (contains(failed, flt) AND NOT regexp_matches(failed, before)) AS removed,
    sum(n) FILTER (contains(failed, flt) AND regexp_matches(failed, before)) AS redundant,
    sum(n) FILTER (failed = flt) AS unique_fails,
    sum(good) FILTER (contains(failed, flt) AND NOT regexp_matches(failed, before)) AS good_lost,
    sum(toxic) FILTER (contains(failed, flt) AND NOT regexp_matches(failed, before)) AS toxic_lost FROM c, p GROUP BY part, filter_order, step)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
    coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, coalesce(sum(removed) OVER (PARTITION BY part, flt), 0)::BIGINT AS shapley FROM r
"""
