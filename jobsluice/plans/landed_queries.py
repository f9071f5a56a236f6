"""Queries of what lands and is published: lines with their rejects, sitemap files, localised dates, feeds as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsluice.functions.fields import MONTHS, localised_date
from jobsluice.operators import feeds
from jobsluice.plans.posting_queries import RULES, tagged, tags_sql
from jobsluice.plans.registry import register
from jobsluice.sources.landed import read_indexed, read_lines
from jobsluice.sources.objects import publish, read_published
from jobsluice.sources.pages import URL
from jobsluice.sources.tables import table
from jobsluice.sources.work import shared_dir

LANGS = ("de", "en", "es", "fr", "it", "pt")


@register("scan_json", """SELECT CASE WHEN conv_id % 7 <> 3 THEN conv_id END AS conv_id, CASE WHEN conv_id % 7 <> 3 THEN turn END AS turn, CASE WHEN conv_id % 7 <> 3 THEN md5(text) END AS digest,
    conv_id % 7 = 3 AS rejected, count(*) AS n FROM conversations GROUP BY ALL""")
def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations land as lines of JSON, some broken off; whole texts come back, broken lines as such."""
    path = f"{shared_dir(spark, 'json')}/conversations"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    line = F.to_json(F.struct("conv_id", "turn", "text"))
    broken = F.col("conv_id") % 7 == 3
    rows.select(F.when(broken, F.concat(F.lit('{"conv_id": x'), F.substring(line, 12, 20))).otherwise(line).alias("value")).write.text(path)
    found = read_lines(spark, path, "json", "conv_id bigint, turn bigint, text string")
    bad = F.col("rejected").isNotNull()
    return found.select("conv_id", "turn", F.md5("text").alias("digest"), bad.alias("rejected")).groupBy("conv_id", "turn", "digest", "rejected").agg(F.count(F.lit(1)).alias("n"))


@register("scan_csv", """SELECT CASE WHEN c_custkey % 9 <> 4 THEN c_custkey END AS c_custkey, CASE WHEN c_custkey % 9 <> 4 THEN '"' || c_name || '", ' || c_mktsegment END AS label,
    CASE WHEN c_custkey % 9 <> 4 THEN c_acctbal END AS c_acctbal, CASE WHEN c_custkey % 9 = 4 THEN 'row ' || c_custkey END AS line FROM customer""")
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers land as CSV whose labels hold quotes and commas; some lines have too few fields and a word for a number."""
    path = f"{shared_dir(spark, 'csv')}/customer"
    rows = table(spark, sf_dir, "customer")
    label = F.concat(F.lit('"'), F.col("c_name"), F.lit('", '), F.col("c_mktsegment"))
    quoted = F.concat(F.lit('"'), F.replace(label, F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), quoted, F.col("c_acctbal").cast("string"))
    rows.select(F.when(F.col("c_custkey") % 9 == 4, F.concat(F.lit("row "), F.col("c_custkey"))).otherwise(line).alias("value")).write.text(path)
    found = read_lines(spark, path, "csv", "c_custkey bigint, label string, c_acctbal double")
    good = F.col("rejected").isNull()
    return found.select(*[F.when(good, F.col(c)).alias(c) for c in ("c_custkey", "label", "c_acctbal")], F.col("rejected").alias("line"))


@register("a1_sitemap_files", """SELECT url AS loc, CASE WHEN page_id % 3 > 0 THEN (DATE '2026-01-01' + (page_id % 300)::INT) END AS lastmod, CASE WHEN page_id % 3 = 0 THEN 'daily' END AS changefreq,
    CASE WHEN page_id % 3 = 0 THEN 0.5 END AS priority FROM pages WHERE url IS NOT NULL AND page_id % 4 <> 2""")
def a1_sitemap_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages' urls land as XML files in four folders, three of which an index names, one of them twice."""
    work = shared_dir(spark, "sitemaps")
    third = F.col("page_id") % 3 == 0
    day = F.when(~third, F.date_add(F.lit("2026-01-01").cast("date"), (F.col("page_id") % 300).cast("int")))
    pages = table(spark, sf_dir, "pages").filter("url is not null")
    rows = pages.select(F.col("url").alias("loc"), day.alias("lastmod"), F.when(third, "daily").alias("changefreq"), F.when(third, 0.5).alias("priority"), (F.col("page_id") % 4).alias("part"))
    rows.write.partitionBy("part").option("rootTag", 'urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"').option("rowTag", "url").format("xml").save(f"{work}/maps")
    index = spark.createDataFrame([(f"{work}/maps/part={k}",) for k in (0, 1, 3, 3)], "loc string")
    index.coalesce(1).write.option("rootTag", "sitemapindex").option("rowTag", "sitemap").format("xml").save(f"{work}/index")
    return read_indexed(spark, f"{work}/index").select(*URL.names)


def _spelled() -> str:
    months = lambda names: "CASE month(d) " + " ".join(f"WHEN {k} THEN '{m}'" for k, m in enumerate(names, 1)) + " END"
    return "CASE lang " + " ".join(f"WHEN '{name}' THEN {months(names)}" for name, names in MONTHS.items()) + " END"


@register("a9_localised", "SELECT o_orderkey, CASE WHEN o_orderkey % 11 < 10 THEN o_orderdate::DATE END AS posted FROM orders")
def a9_localised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates are spelled in six languages in four ways by their key, some in a language that is unknown, and read again."""
    lang = F.element_at(F.array(*map(F.lit, LANGS)), (F.col("o_orderkey") % len(LANGS) + 1).cast("int"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"), lang.alias("lang"))
    rows = rows.withColumn("m", F.expr(_spelled())).withColumn("k", F.expr("o_orderkey div 6 % 4"))
    part = lambda *x: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in x])
    day, year, month = F.dayofmonth("d"), F.year("d"), F.initcap("m")
    raw = F.when(F.col("k") == 0, part(day, " ", F.col("m"), " ", year)).when(F.col("k") == 1, part(day, ". ", month, " ", year)).when(F.col("k") == 2, part(day, " de ", F.col("m"), " de ", year)).otherwise(part(month, " ", day, ", ", year))
    known = F.when(F.col("o_orderkey") % 11 < 10, F.col("lang")).otherwise("xx")
    return rows.select("o_orderkey", localised_date(raw, known).alias("posted"))


PUBLISHED = "CASE WHEN c_custkey % 5 = 0 THEN 'MOVED' ELSE c_mktsegment END"


@register("a16_published", f"SELECT {PUBLISHED} AS segment, count(*) AS n, min(c_custkey) AS first_key FROM customer WHERE c_custkey % 8 > 0 GROUP BY 1")
def a16_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset published, replaced by one made from itself, and left as it was by a writer that dies before its last step."""
    path = f"{shared_dir(spark, 'published')}/customer"
    publish(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), path)
    moved = read_published(spark, path).filter("c_custkey % 8 > 0").select("c_custkey", F.expr(PUBLISHED).alias("segment"))
    publish(moved, path, ("segment",))
    publish(moved.limit(1), path, ("segment",), last_step=False)
    rows = read_published(spark, path, "c_custkey long, segment string")
    return rows.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.min("c_custkey").alias("first_key"))


#: A feed for each customer: its conditions by the customer's key.
MADE = """'feed-' || c_custkey AS feed, CASE c_custkey % 6 WHEN 0 THEN 'en' WHEN 1 THEN 'de' WHEN 2 THEN 'es' WHEN 3 THEN 'fr' END AS lang,
    CASE c_custkey % 7 WHEN 0 THEN 'licensed' WHEN 1 THEN 'english' WHEN 2 THEN 'contact' WHEN 3 THEN 'romance' END AS tag, CAST(c_custkey * 37 % 2000 AS BIGINT) AS low,
    CAST(c_custkey * 37 % 2000 + c_custkey % 11 * 100 AS BIGINT) AS high, CASE WHEN c_custkey % 3 = 0 THEN DATE '2026-03-01' END AS since,
    CASE WHEN c_custkey % 4 = 0 THEN DATE '2026-09-01' END AS until, CAST(1 + c_custkey % 9 AS INT) AS most"""


@register("b16_feed_table", f"""WITH t AS (SELECT doc_id, lang, n_chars, DATE '2026-01-01' + (doc_id % 365)::INT AS day, {tags_sql(RULES)} AS tags FROM documents), f AS (SELECT {MADE} FROM customer)
    SELECT feed, row_number() OVER (PARTITION BY feed ORDER BY n_chars DESC, doc_id) AS rank, doc_id FROM t JOIN f ON n_chars >= low AND n_chars < high AND (f.lang IS NULL OR t.lang = f.lang)
    AND (tag IS NULL OR list_contains(tags, tag)) AND (since IS NULL OR day >= since) AND (until IS NULL OR day < until) QUALIFY rank <= most""")
def b16_feed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the feeds of as many customers as there are, read from a table of feeds."""
    day = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    rows = tagged(spark, sf_dir, "lang", "n_chars").withColumn("neg", -F.col("n_chars")).withColumn("day", day)
    made = spark.sql(f"SELECT {MADE} FROM {{customer}}", customer=table(spark, sf_dir, "customer"))
    routed = feeds.route_table(rows, made, F.col("lang"), F.col("tags"), F.col("n_chars"), F.col("day"), ["neg", "doc_id"])
    return routed.select("feed", "rank", "doc_id")

