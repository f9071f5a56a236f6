"""Queries of joins on time, sessions, rule tables and seen filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsluice.operators.rule_index import tag_rows
from jobsluice.operators.seen_filter import drop_seen_by_filter, filter_of, merged_filters, words_for
from jobsluice.operators.timejoin import asof_join, interval_join, sessions
from jobsluice.plans.registry import register
from jobsluice.sources.tables import table
from jobsluice.sources.work import stored


def _kind(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter(F.col("event_type") == kind).select("event_id", "user_id", "ts")


@register("asof_events", """SELECT event_id, user_id, m.id AS click_id, epoch_us(ts) - m.at AS age FROM (
    SELECT p.event_id, p.user_id, p.ts, max({'at': epoch_us(c.ts), 'id': c.event_id}) AS m FROM events p
    LEFT JOIN events c ON c.event_type = 'click' AND c.user_id = p.user_id AND c.ts <= p.ts AND epoch_us(p.ts) - epoch_us(c.ts) <= 2 * 86400 * 1000000::BIGINT
    WHERE p.event_type = 'purchase' GROUP BY ALL)""")
def asof_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the same user's latest click in the two days before."""
    rows = asof_join(_kind(spark, sf_dir, "purchase"), _kind(spark, sf_dir, "click"), "user_id", "ts", 2 * 86400, "event_id", "click")
    age = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("click.ts").cast("timestamp"))
    return rows.select("event_id", "user_id", F.col("click.event_id").alias("click_id"), age.alias("age"))


@register("interval_events", """SELECT e.event_id, s.event_id AS signup_id FROM events e JOIN events s ON s.user_id = e.user_id AND epoch_us(s.ts) BETWEEN epoch_us(e.ts) - 6 * 3600 * 1000000::BIGINT AND epoch_us(e.ts) + 3600 * 1000000::BIGINT
    WHERE e.event_type = 'error' AND s.event_type = 'signup'""")
def interval_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors with the same user's signups from six hours before to one after."""
    pairs = interval_join(_kind(spark, sf_dir, "error"), _kind(spark, sf_dir, "signup"), "user_id", "ts", 6 * 3600, 3600)
    return pairs.select("left.event_id", F.col("right.event_id").alias("signup_id"))


SESSIONS_SQL = """WITH g AS (SELECT user_id, epoch_us(ts) AS t, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) <= 86400 * 1000000::BIGINT THEN 0 ELSE 1 END AS opens FROM events),
    s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS session FROM g)
    SELECT user_id, min(t) AS first, max(t) AS last, count(*) AS n FROM s GROUP BY user_id, session"""


@register("b24_sessions", SESSIONS_SQL)
def b24_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions(table(spark, sf_dir, "events"), "user_id", "ts", 86400).withColumnRenamed("key", "user_id")


def long_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule for each word of nine letters or more that stands in several documents: plain, a list, or a pattern."""
    words = table(spark, sf_dir, "documents").select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{9,}"), F.lit(0)))).alias("word"))
    words = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    form = F.length("word") % 4
    w, back = F.col("word"), F.reverse("word")
    include = F.when(form == 0, w).when(form == 1, F.concat(w, F.lit(" [a-z]+"))).when(form == 2, F.concat_ws("|", w, back)).otherwise(F.concat(F.lit("[a-z]+ "), w))
    exclude = F.when(form == 2, "the").when(form == 3, "(und|que) [a-z]+")
    return words.select(F.concat(F.lit("r-"), w).alias("tag"), F.lit(1).alias("priority"), include.alias("include"), exclude.alias("exclude"), F.lit(None).cast("string").alias("second"))


#: For the oracle, which is slow on classes of Unicode: all but letters, digits and spaces is one sign before.
_HEAD, _TAIL = "(^|[# ])(", ")($|[# ])"


@register("b10_rule_index", rf"""WITH d AS (SELECT doc_id, regexp_replace(lower(text), '[^\p{{L}}\p{{N}} ]', '#', 'g') AS t FROM documents),
    w AS (SELECT unnest(list_distinct(regexp_extract_all(t, '[a-z]{{9,}}'))) AS word FROM d),
    r AS (SELECT word, CASE length(word) % 4 WHEN 0 THEN word WHEN 1 THEN word || ' [a-z]+' WHEN 2 THEN word || '|' || reverse(word) ELSE '[a-z]+ ' || word END AS include,
        CASE length(word) % 4 WHEN 2 THEN 'the' WHEN 3 THEN '(und|que) [a-z]+' END AS exclude FROM w GROUP BY word HAVING count(*) > 1),
    h AS (SELECT doc_id, t, word, exclude FROM d JOIN r ON CASE WHEN contains(t, word) OR (length(word) % 4 = 2 AND contains(t, reverse(word))) THEN regexp_matches(t, '{_HEAD}' || include || '{_TAIL}') ELSE false END)
    SELECT doc_id, string_agg('r-' || word, ',' ORDER BY 'r-' || word) AS tags FROM h WHERE exclude IS NULL OR NOT regexp_matches(t, '{_HEAD}' || exclude || '{_TAIL}') GROUP BY doc_id""")
def b10_rule_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags by thousands of rules, which are made of the documents' own words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("small"))
    return tag_rows(docs, long_words(spark, sf_dir), "doc_id", "small").select("doc_id", F.array_join("tags", ",").alias("tags"))


@register("b3_seen_filter", """SELECT o_orderkey, o_custkey FROM orders n WHERE o_orderdate >= '2000-01-01' AND NOT EXISTS (SELECT 1 FROM orders s WHERE s.o_custkey = n.o_custkey AND s.o_orderdate < '1997-01-01' AND s.o_orderstatus IN ('F', 'O'))""")
def b3_seen_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers that neither of two earlier outputs has, each of which keeps a filter of its own."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    seen = orders.filter("o_orderdate < '1997-01-01' and o_orderstatus in ('F', 'O')").select("o_custkey", "o_orderstatus")
    words = words_for(seen.count())
    filters = [stored(filter_of(seen.filter(F.col("o_orderstatus") == s), ["o_custkey"], words), "filter") for s in ("F", "O")]
    rows = orders.filter("o_orderdate >= '2000-01-01'").select("o_orderkey", "o_custkey")
    return drop_seen_by_filter(rows, seen, ["o_custkey"], merged_filters(*filters), words)
