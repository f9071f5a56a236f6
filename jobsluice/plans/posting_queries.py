"""Queries over postings: duplicates, tags, places, feeds, snapshots and health."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsluice.functions.text import delimited
from jobsluice.operators import checks, dedup, feeds, health, location, snapshots, tagging
from jobsluice.plans.registry import register
from jobsluice.sources.objects import dataset_pairs, read_dataset, write_dataset
from jobsluice.sources.tables import table
from jobsluice.sources.work import shared_dir

RULES = [
    tagging.Rule("licensed", 10, r"licensed under [a-z0-9 .-]+|all rights reserved"),
    tagging.Rule("credential", 20, r"token", exclude=r"reserved"),
    tagging.Rule("contact", 30, r"mail[0-9]*"),
    tagging.Rule("english", 50, r"the|and", exclude=r"die|der"),
    tagging.Rule("german", 51, r"und|der", exclude=r"the"),
    tagging.Rule("romance", 52, r"est|las|que", exclude=r"the|und", second="^src1[0-9]$"),
]
#: A second table of rules, whose effect is reported against the first.
RULES_NEW = [r for r in RULES if r.tag != "contact"] + [tagging.Rule("network", 15, r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}")]
FEEDS = [
    feeds.Feed("en-long", "en", None, 1000, 1 << 40, datetime.date(2026, 3, 1), datetime.date(2026, 10, 1), 40),
    feeds.Feed("en-short", "en", None, 0, 1000, None, None, 25),
    feeds.Feed("iberia", "es", None, 200, 5000, datetime.date(2026, 2, 1), None, 20),
    feeds.Feed("licensed", None, "licensed", 0, 1 << 40, None, datetime.date(2026, 12, 1), 30),
]


def rule_table(spark: SparkSession, rules: list[tagging.Rule]) -> DataFrame:
    """The table of rules that a query reads; elsewhere it is a dataset of its own."""
    return spark.createDataFrame([tuple(r) for r in rules], "tag string, priority int, include string, exclude string, second string")


def feed_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([tuple(f) for f in FEEDS], "feed string, lang string, tag string, low long, high long, since date, until date, most int")


def tags_sql(rules: list[tagging.Rule], guarded: bool = True) -> str:
    held = []
    for r in rules:
        hit = f"regexp_matches(lower(text), '{delimited(r.include)}')"
        if r.second:
            hit = f"({hit} OR regexp_matches(source, '{r.second}'))"
        if r.exclude and guarded:
            hit += f" AND NOT regexp_matches(lower(text), '{delimited(r.exclude)}')"
        held.append(f"CASE WHEN {hit} THEN '{r.tag}' END")
    return f"list_sort(list_distinct(list_filter([{', '.join(held)}], lambda t: t IS NOT NULL)))"


def primary_sql(rules: list[tagging.Rule], tagged: str) -> str:
    order = sorted(rules, key=lambda r: (r.priority, r.tag))
    return "CASE " + " ".join(f"WHEN list_contains({tagged}, '{r.tag}') THEN '{r.tag}'" for r in order) + " ELSE 'general' END"


def tagged(spark: SparkSession, sf_dir: str, *columns: str, rules: list[tagging.Rule] | None = None) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    small = docs.withColumn("small", F.lower("text"))
    known = tagging.rules_of(rule_table(spark, rules or RULES))
    return small.select("doc_id", *columns, tagging.tags(known, F.col("small"), F.col("source")).alias("tags"))


def split_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two snapshots of orders: before 1999, and from 1997 on with other states for some."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    later = orders.filter("o_orderdate >= '1997-01-01'").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 50 == 0, "X").otherwise(F.col("o_orderstatus")))
    return orders.filter("o_orderdate < '1999-01-01'"), later


SNAPSHOTS_SQL = """a AS (SELECT o_orderkey, o_orderstatus AS s FROM orders WHERE o_orderdate < '1999-01-01'),
b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders WHERE o_orderdate >= '1997-01-01')"""


@register("a14_parity", f"""WITH {SNAPSHOTS_SQL} SELECT o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'left_only' WHEN a.o_orderkey IS NULL THEN 'right_only' ELSE 'changed' END AS kind
    FROM a FULL JOIN b USING (o_orderkey) WHERE a.s IS DISTINCT FROM b.s OR a.o_orderkey IS NULL OR b.o_orderkey IS NULL""")
def a14_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.differences(*split_orders(spark, sf_dir), ["o_orderkey"])


NORM_SQL = r"regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')"


@register("b1_dedup", f"SELECT min(doc_id) AS doc_id, md5({NORM_SQL}) AS key FROM documents GROUP BY {NORM_SQL}")
def b1_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.md5(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}]+", " "))
    rows = table(spark, sf_dir, "documents").select("doc_id", key.alias("key"))
    return dedup.keep_first(rows, ["key"], ["doc_id"])


@register("b2_dedup_ttl", """SELECT event_id, user_id, ts FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
    WHERE p IS NULL OR epoch_us(ts) - epoch_us(p) > 7 * 86400 * 1000000::BIGINT""")
def b2_dedup_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return dedup.drop_within_ttl(rows, F.col("user_id"), "ts", 7 * 86400, "event_id")


@register("b3_seen_anti", "SELECT c_custkey, c_mktsegment FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate < '1997-06-01')")
def b3_seen_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = table(spark, sf_dir, "orders").filter("o_orderdate < '1997-06-01'").select(F.col("o_custkey").alias("c_custkey"))
    return dedup.drop_seen(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), seen, ["c_custkey"])


@register("b4_upsert", """SELECT o_custkey, min(o_orderdate)::DATE AS first_seen, max(o_orderdate)::DATE AS last_seen FROM orders GROUP BY o_custkey""")
def b4_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders before 1998 make the seen table, the others come as a second run."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    old, new = orders.filter("day < '1998-01-01'"), orders.filter("day >= '1998-01-01'")
    seen = old.groupBy("o_custkey").agg(F.min("day").alias("first_seen"), F.max("day").alias("last_seen"))
    return dedup.upsert_seen(seen, new, "o_custkey")


#: Rules of validity: in Spark, and for the oracle.
CHECKS = {
    "has_text": (lambda: F.length(F.trim("text")) > 0, "length(trim(text)) > 0"),
    "long_enough": (lambda: F.col("n_chars") >= 60, "n_chars >= 60"),
    "known_lang": (lambda: F.col("lang").isin("en", "fr", "de", "es"), "lang IN ('en', 'fr', 'de', 'es')"),
    "no_noise": (lambda: ~F.col("text").rlike(r"(%%%|###|\*\*\*)"), r"NOT regexp_matches(text, '(%%%|###|\*\*\*)')"),
    "no_token": (lambda: ~F.col("text").contains("token ="), "NOT contains(text, 'token =')"),
}


@register("b5_validate", "SELECT doc_id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN NOT ({CHECKS[c][1]}) THEN '{c}' END" for c in sorted(CHECKS)) + "], lambda r: r IS NOT NULL), ',') AS reasons FROM documents")
def b5_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, quarantined = checks.validate(table(spark, sf_dir, "documents"), {k: rule() for k, (rule, _) in CHECKS.items()})
    return valid.select("doc_id", F.lit("").alias("reasons")).unionByName(quarantined.select("doc_id", F.array_join("reasons", ",").alias("reasons")))


@register("b6_display", "SELECT s_suppkey, s_name || ', ' || n_name || ', ' || r_name AS place FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def b6_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.select("s_suppkey", location.display_place(F.col("s_name"), F.col("n_name"), F.col("r_name")).alias("place"))


@register("b7_country", "SELECT c_custkey, 'C' || (n_nationkey // 2) AS country FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_nationkey % 5 > 0 UNION ALL SELECT c_custkey, NULL FROM customer WHERE c_nationkey % 5 = 0")
def b7_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases are spelled with an accent that the places lack; every fifth nation has none."""
    nation = table(spark, sf_dir, "nation")
    aliases = nation.filter("n_nationkey % 5 > 0").select(F.concat(F.lit("Nación "), "n_nationkey").alias("alias"), F.concat(F.lit("C"), F.expr("n_nationkey div 2")).alias("country"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("Town "), F.col("c_custkey") % 7, F.lit(", NACION "), "c_nationkey").alias("place"))
    return location.resolve_country(rows, "place", aliases).select("c_custkey", "country")


@register("b8_any_place", """SELECT l_orderkey, count(DISTINCT n_name) AS n_places FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    GROUP BY l_orderkey HAVING bool_or(n_name IN ('NATION_3', 'NATION_7'))""")
def b8_any_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    per = rows.groupBy("l_orderkey").agg(F.collect_set("n_name").alias("places")).filter(location.in_any_place(F.col("places"), ["NATION_3", "NATION_7"]))
    return per.select("l_orderkey", F.size("places").cast("long").alias("n_places"))


@register("b8_places", """SELECT DISTINCT l_orderkey, n_name AS place FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""")
def b8_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's list of places as one row for each place."""
    places = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    return location.places_of(rows.groupBy("l_orderkey").agg(F.collect_list("n_name").alias("places")), "l_orderkey", "places")


@register("b10_tags", f"SELECT doc_id, array_to_string({tags_sql(RULES, guarded=False)}, ',') AS tags FROM documents")
def b10_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    small = table(spark, sf_dir, "documents").withColumn("small", F.lower("text"))
    rules = tagging.rules_of(rule_table(spark, RULES))
    return small.select("doc_id", F.array_join(tagging.tags(rules, F.col("small"), F.col("source"), guarded=False), ",").alias("tags"))


@register("b11_guarded", f"SELECT doc_id, array_to_string({tags_sql(RULES)}, ',') AS tags FROM documents")
def b11_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagged(spark, sf_dir).select("doc_id", F.array_join("tags", ",").alias("tags"))


@register("b12_primary", f"SELECT doc_id, {primary_sql(RULES, 'tags')} AS tag FROM (SELECT doc_id, {tags_sql(RULES)} AS tags FROM documents)")
def b12_primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagged(spark, sf_dir).select("doc_id", tagging.primary(RULES, F.col("tags")).alias("tag"))


@register("b15_lang_cube", f"SELECT lang, tag, count(*) AS n, grouping(lang, tag) AS level FROM (SELECT lang, {primary_sql(RULES, 'tags')} AS tag FROM (SELECT lang, {tags_sql(RULES)} AS tags FROM documents)) GROUP BY CUBE (lang, tag)")
def b15_lang_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tagged(spark, sf_dir, "lang").select("lang", tagging.primary(RULES, F.col("tags")).alias("tag"))
    return rows.cube("lang", "tag").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"))


def _feeds_sql() -> str:
    parts = []
    for f in FEEDS:
        hold = f"n_chars >= {f.low} AND n_chars < {f.high}" + (f" AND lang = '{f.lang}'" if f.lang else "") + (f" AND list_contains(tags, '{f.tag}')" if f.tag else "")
        hold += (f" AND day >= DATE '{f.since}'" if f.since else "") + (f" AND day < DATE '{f.until}'" if f.until else "")
        parts.append(f"SELECT '{f.feed}' AS feed, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS rank, doc_id FROM t WHERE {hold} QUALIFY rank <= {f.most}")
    return f"WITH t AS (SELECT doc_id, lang, n_chars, DATE '2026-01-01' + (doc_id % 365)::INT AS day, {tags_sql(RULES)} AS tags FROM documents) " + " UNION ALL ".join(parts)


@register("b16_route", _feeds_sql())
def b16_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    rows = tagged(spark, sf_dir, "lang", "n_chars").withColumn("neg", -F.col("n_chars")).withColumn("day", day)
    routed = feeds.route(rows, feeds.feeds_of(feed_table(spark)), F.col("lang"), F.col("tags"), F.col("n_chars"), F.col("day"), ["neg", "doc_id"])
    return routed.select("feed", "rank", "doc_id")


@register("b17_feed_stats", """SELECT o_orderpriority, o_orderstatus, grouping(o_orderpriority, o_orderstatus) AS level, count(*) AS n, max(o_orderdate)::DATE AS newest, count(DISTINCT o_custkey) AS n_orgs
    FROM orders GROUP BY ROLLUP (o_orderpriority, o_orderstatus)""")
def b17_feed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    return feeds.feed_stats(rows, ["o_orderpriority", "o_orderstatus"], "o_custkey", "day")


@register("b18_active", "SELECT o_orderkey, o_orderdate::DATE AS day FROM orders WHERE o_orderdate > DATE '1998-06-30' - 90 AND o_orderdate < DATE '1998-07-01'")
def b18_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = checks.active(table(spark, sf_dir, "orders"), "o_orderdate", F.lit("1998-06-30").cast("date"), 90)
    return rows.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))


@register("b19_snapshot", f"""WITH {SNAPSHOTS_SQL} SELECT o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'added' WHEN b.o_orderkey IS NULL THEN 'removed' WHEN a.s = b.s THEN 'kept' ELSE 'changed' END AS state FROM a FULL JOIN b USING (o_orderkey)""")
def b19_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.lifecycle(*split_orders(spark, sf_dir), ["o_orderkey"])


@register("b20_preserve", """SELECT doc_id, source, CASE WHEN doc_id % 4 = 1 THEN 'added' WHEN doc_id % 4 = 2 THEN CASE WHEN source IN ('src1', 'src3', 'src5') THEN 'preserved' ELSE 'retired' END ELSE 'kept' END AS state FROM documents""")
def b20_preserve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the documents some are only in the earlier run and some only in the later; three sources failed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    state = docs.select("source").distinct().withColumn("ok", ~F.col("source").isin("src1", "src3", "src5"))
    return snapshots.retire_safely(docs.filter("doc_id % 4 <> 1"), docs.filter("doc_id % 4 <> 2"), state, "doc_id", "source")


@register("b22_backfill", "SELECT doc_id, coalesce(CASE WHEN doc_id % 2 = 0 THEN n_chars::INT % 2 END, quality) AS quality, toxic FROM documents LEFT JOIN labels USING (doc_id)")
def b22_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, (F.col("n_chars") % 2).cast("int")).alias("quality"))
    return checks.backfill(docs, table(spark, sf_dir, "labels"), "doc_id", ["quality", "toxic"])


@register("b23_rotation", """WITH s AS (SELECT event_type, user_id, max(ts) AS seen FROM events GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY seen, user_id) AS turn FROM s)
SELECT event_type, user_id, turn FROM k ORDER BY turn > 5, seen, event_type, user_id LIMIT 40""")
def b23_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.max("ts").alias("seen"))
    return checks.rotation(seen, "event_type", "user_id", "seen", 5, 40)


@register("b24_health", """SELECT date_trunc('day', ts)::DATE AS start, event_type, count(*) AS n, round(count(*) FILTER (value > 150) / count(*), 6) AS error_share, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95,
    max(try_cast(json_extract_string(props, '$.k') AS INT)) AS max_k FROM events GROUP BY ALL""")
def b24_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("int")
    return health.health(table(spark, sf_dir, "events"), F.col("ts").cast("date"), "event_type", F.col("value") > 150, "value", max_k=k)


@register("b25_drift", """WITH c AS (SELECT date_trunc('week', ts)::DATE AS week, event_type, count(*) AS n FROM events GROUP BY ALL),
s AS (SELECT week, event_type, n / sum(n) OVER (PARTITION BY week) AS share FROM c),
d AS (SELECT *, share - lag(share) OVER (PARTITION BY event_type ORDER BY week) AS change FROM s)
SELECT week, event_type, round(share, 6) AS share, round(change, 6) AS change, coalesce(abs(change) > 0.02, false) AS flagged FROM d""")
def b25_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.trunc("ts", "week").alias("week"), "event_type")
    return tagging.drift(rows, "week", "event_type", 0.02).withColumns({c: F.round(c, 6) for c in ("share", "change")})


@register("b26_tag_diff", f"""SELECT old_tag, new_tag, count(*) AS n FROM (SELECT {primary_sql(RULES, 'a')} AS old_tag, {primary_sql(RULES_NEW, 'b')} AS new_tag FROM (SELECT {tags_sql(RULES)} AS a, {tags_sql(RULES_NEW)} AS b FROM documents)) GROUP BY ALL""")
def b26_tag_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").withColumn("small", F.lower("text"))
    old, new = (tagging.rules_of(rule_table(spark, rules)) for rules in (RULES, RULES_NEW))
    both = rows.select(*[tagging.tags(rules, F.col("small"), F.col("source")).alias(name) for rules, name in ((old, "a"), (new, "b"))])
    return tagging.contingency(both, tagging.primary(old, F.col("a")), tagging.primary(new, F.col("b")))


@register("b27_residue", f"""WITH t AS (SELECT text, {tags_sql(RULES)} AS tags FROM documents) SELECT token, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '[ \\t\\n\\r\\.,]+')) AS token FROM t WHERE len(tags) = 0)
    WHERE token <> '' GROUP BY token ORDER BY n DESC, token LIMIT 50""")
def b27_residue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagging.residue(tagged(spark, sf_dir, "text").filter(F.size("tags") == 0), F.col("text"), 50)


@register("b27_sample", "SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY (doc_id * 7919) % 10007, doc_id) AS k FROM documents) WHERE k <= 3")
def b27_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagging.stratified(table(spark, sf_dir, "documents").select("source", "doc_id"), "source", "doc_id", 3)


@register("b28_quality", f"""SELECT tp, fp, fn, CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 6) END AS "precision", CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 6) END AS recall FROM (
    SELECT count(*) FILTER (p AND q) AS tp, count(*) FILTER (p AND NOT q) AS fp, count(*) FILTER (NOT p AND q) AS fn FROM (
    SELECT len(list_intersect(tags, ['english', 'german', 'romance'])) = 1 AS p, quality = 1 AS q FROM (SELECT doc_id, {tags_sql(RULES)} AS tags FROM documents) JOIN labels USING (doc_id)))""")
def b28_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well one clear language tag tells a document of quality."""
    rows = tagged(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    clear = F.size(F.array_intersect("tags", F.array(F.lit("english"), F.lit("german"), F.lit("romance")))) == 1
    return rows.select(clear.alias("p"), (F.col("quality") == 1).alias("q")).agg(*tagging.quality(F.col("p"), F.col("q")))


@register("b29_region", "SELECT r_name, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def b29_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes a dataset with one partition for each region, and reads its figures from there."""
    path = f"{shared_dir(spark, 'region')}/customers"
    write_dataset(regional(spark, sf_dir), path, ("r_name",))
    return read_dataset(spark, path).groupBy("r_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@register("a15_pairs", """SELECT 'nation' AS dataset, 'changed' AS kind, count(*) AS n FROM nation WHERE n_nationkey % 5 = 0 UNION ALL SELECT 'customer', 'right_only', count(*) FROM customer
    UNION ALL SELECT 'supplier', 'left_only', count(*) FROM supplier""")
def a15_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders of datasets: one dataset equal, one changed, and one in either folder alone; pairs come from the folders."""
    work = shared_dir(spark, "pairs")
    t = lambda name: table(spark, sf_dir, name)
    for name in ("region", "nation", "supplier"):
        write_dataset(t(name), f"{work}/left/{name}")
    write_dataset(t("region"), f"{work}/right/region")
    write_dataset(t("nation").withColumn("n_name", F.when(F.col("n_nationkey") % 5 == 0, "X").otherwise(F.col("n_name"))), f"{work}/right/nation")
    write_dataset(t("customer"), f"{work}/right/customer")
    keys = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"]}
    return snapshots.parity_report(spark, dataset_pairs(spark, f"{work}/left", f"{work}/right"), keys)


@register("a16_objects", "SELECT c_mktsegment, count(*) AS n, min(c_custkey) AS first_key FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY c_mktsegment")
def a16_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset written by segment where Spark's file systems reach, and read back but for one partition."""
    path = f"{shared_dir(spark, 'objects')}/customer"
    write_dataset(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), path, ("c_mktsegment",))
    rows = read_dataset(spark, path, "c_custkey long, c_mktsegment string").filter("c_mktsegment <> 'BUILDING'")
    return rows.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.min("c_custkey").alias("first_key"))


def regional(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "c_acctbal", "n_name", "r_name")


@register("b30_archive", """SELECT CASE WHEN o_orderdate < '1998-01-01' THEN strftime(o_orderdate, '%Y-%m') ELSE 'live' END AS month, count(*) AS n, min(o_orderkey) AS first_key FROM orders GROUP BY 1""")
def b30_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    live, old = snapshots.archive(table(spark, sf_dir, "orders"), "o_orderdate", F.lit("1998-01-01").cast("timestamp_ntz"))
    rows = live.select("o_orderkey", F.lit("live").alias("month")).unionByName(old.select("o_orderkey", "month"))
    return rows.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"))


@register("b31_dim_guard", """SELECT 'duplicate nations' AS check_name, count(*) AS n FROM (SELECT n_name FROM nation GROUP BY n_name HAVING count(*) > 1)
    UNION ALL SELECT 'duplicate labels', count(*) FROM (SELECT quality, doc_id % 1000 AS k FROM labels GROUP BY ALL HAVING count(*) > 1)
    UNION ALL SELECT 'customers without nation', count(*) FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation)
    UNION ALL SELECT 'pages without document', count(*) FROM pages WHERE page_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 3 > 0)
    UNION ALL SELECT 'blank segments', count(*) FROM customer WHERE trim(coalesce(c_mktsegment, '')) = ''""")
def b31_dim_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    parts = [
        checks.duplicate_keys(t("nation"), "n_name", "duplicate nations"),
        checks.duplicate_keys(t("labels").select(F.struct("quality", F.col("doc_id") % 1000).alias("k")), "k", "duplicate labels"),
        checks.orphans(t("customer"), "c_nationkey", t("nation"), "n_nationkey", "customers without nation"),
        checks.orphans(t("pages"), "page_id", t("documents").filter("doc_id % 3 > 0"), "doc_id", "pages without document"),
        checks.blanks(t("customer"), "c_mktsegment", "blank segments"),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows
