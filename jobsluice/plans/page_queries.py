"""Queries from landed pages to fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsluice.functions.fields import MONTHS_ES, employment_kind, experience, months_of_experience, posted_date, salary, seniority, split_place
from jobsluice.functions.text import decode_entities, decode_named, html_to_text, strip_label
from jobsluice.operators.dedup import capped, keep_first
from jobsluice.plans.registry import register
from jobsluice.sources.pages import explode_sitemap, first_of, host_of, lang_of, links, listing_items, microdata, page_fields, page_posting_id, posting_id, posting_urls, primary_language
from jobsluice.sources.tables import table

HOST_SQL = "regexp_extract(url, '://([^/?#]*)', 1)"
ID_SQL = "try_cast(regexp_extract(url, '^[a-z]+://[^/?#]+/(en|fr|de|es)/([0-9]+)', 2) AS BIGINT)"
ANCHORS_SQL = """SELECT page_id, url, html, pos - 1 AS pos, a FROM (SELECT *, unnest(anchors) AS a, generate_subscripts(anchors, 1) AS pos
    FROM (SELECT page_id, url, html, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') AS anchors FROM pages))"""


def named_sql(text: str) -> str:
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&nbsp;", " "), ("&amp;", "&")):
        text = f"replace({text}, '{name}', '{char}')"
    return text


LINKS_SQL = f"""SELECT page_id, url, html, pos, regexp_extract(a, 'href="([^"]*)"', 1) AS href, {named_sql("regexp_extract(a, '>([^<]*)<', 1)")} AS label FROM ({ANCHORS_SQL})"""


@register("link_hosts", f"""SELECT {HOST_SQL} AS host, regexp_extract(html, '<html[^>]* lang="([^"]*)"', 1) AS lang, count(*) AS n_links
    FROM (SELECT DISTINCT page_id, url, html, href FROM ({LINKS_SQL})) GROUP BY ALL""")
def link_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = links(pages).select("page_id", "href").distinct().groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))
    heads = pages.select("page_id", host_of(F.col("url")).alias("host"), lang_of(F.col("html")).alias("lang"))
    return heads.join(found, "page_id").groupBy("host", "lang").agg(F.sum("n").alias("n_links"))


@register("a1_sitemap", f"""SELECT url AS loc, (DATE '2026-01-01' + (page_id % 300)::INT) AS lastmod, CASE WHEN page_id % 3 = 0 THEN 'daily' END AS changefreq, CASE WHEN page_id % 3 = 0 THEN 0.5 END AS priority
    FROM pages WHERE url IS NOT NULL""")
def a1_sitemap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sitemaps are made from the page table, at most 50 urls each, and exploded again."""
    pages = table(spark, sf_dir, "pages").filter("url is not null")
    loc = F.replace(F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    day = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("page_id") % 300).cast("int"))
    extra = F.when(F.col("page_id") % 3 == 0, "<changefreq>daily</changefreq><priority>0.5</priority>").otherwise("")
    entry = F.concat(F.lit("<url><loc>"), loc, F.lit("</loc><lastmod>"), day.cast("string"), F.lit("</lastmod>"), extra, F.lit("</url>"))
    maps = pages.groupBy(host_of(F.col("url")).alias("host"), F.expr("page_id div 50").alias("part")).agg(F.array_join(F.collect_list(entry), "").alias("urls"))
    return explode_sitemap(maps.select(F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), "urls", F.lit("</urlset>")).alias("xml")))


@register("a2_url_filter", "SELECT page_id, url FROM pages WHERE regexp_matches(url, '^[a-z]+://[^/?#]+/(en|fr|de|es)/([0-9]+)')")
def a2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_urls(table(spark, sf_dir, "pages")).select("page_id", "url")


@register("a2_forms", f"""SELECT page_id, CASE WHEN page_id % 5 < 3 THEN page_id + 40000000000 ELSE {ID_SQL} END AS job_id FROM pages
    WHERE page_id % 5 < 3 OR (page_id % 5 = 4 AND regexp_matches(url, '^[a-z]+://[^/?#]+/(en|fr|de|es)/([0-9]+)'))""")
def a2_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's url in one of the forms of postings, or in one that is none."""
    host, job = F.concat(F.lit("https://"), host_of(F.col("url"))), F.col("page_id") + F.lit(40_000_000_000)
    k = F.col("page_id") % 5
    url = (
        F.when(k == 0, F.concat(host, F.lit("/job/Role-of-"), "page_id", F.lit("/"), job, F.lit("/")))
        .when(k == 1, F.concat(host, F.lit("/North/job/Role-"), "page_id", F.lit("/"), job, F.lit("/?src=a")))
        .when(k == 2, F.concat(F.lit("/en/job/town/role-"), "page_id", F.lit("/7/"), job))
        .when(k == 3, F.concat(host, F.lit("/about/job/"), job))
        .otherwise(F.col("url"))
    )
    return posting_urls(table(spark, sf_dir, "pages").select("page_id", url.alias("url"))).select("page_id", posting_id(F.col("url")).alias("job_id"))


@register("a3_page_ids", f"SELECT page_id, {ID_SQL} AS job_id FROM pages")
def a3_page_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of the url is written into the page, as a parameter or in a link, and found there."""
    job = posting_id(F.col("url"))
    form = F.concat(F.lit('<form action="/subscribe/?locale=xx&amp;jobid='), job, F.lit('" method="post">'))
    link = F.concat(F.lit('<a class="apply" href="/talents/apply/'), job, F.lit('/?locale=xx">'))
    page = F.coalesce(F.concat(F.when(F.col("page_id") % 2 == 0, form).otherwise(link), "html"), F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", page_posting_id(page).alias("job_id"))


@register("a3_id_join", f"SELECT doc_id, lang, source, n_pages FROM documents JOIN (SELECT {ID_SQL} AS doc_id, count(*) AS n_pages FROM pages GROUP BY 1) USING (doc_id)")
def a3_id_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "pages").groupBy(posting_id(F.col("url")).alias("doc_id")).agg(F.count(F.lit(1)).alias("n_pages"))
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(ids, "doc_id")


@register("a3_not_fetched", f"SELECT source, count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT {ID_SQL} FROM pages WHERE {ID_SQL} IS NOT NULL) GROUP BY source")
def a3_not_fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "pages").select(posting_id(F.col("url")).alias("doc_id")).distinct()
    return table(spark, sf_dir, "documents").join(ids, "doc_id", "left_anti").groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@register("a4_links", f"SELECT page_id, pos, href, label FROM ({LINKS_SQL})")
def a4_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links(table(spark, sf_dir, "pages"))


TITLE_SQL = named_sql("regexp_extract(html, '<title>([^<]*)', 1)")


@register("a4_listing", f"""SELECT (page_id + 40000000000)::VARCHAR AS job_id, '7' AS org_id, '/en/job/town/' || t || '/7/' || (page_id + 40000000000) AS href, nullif(t, '') AS title,
    'Town ' || (page_id % 9) || ', Land & Sea' AS location, 'Sales and more' AS category FROM (SELECT page_id, {TITLE_SQL} AS t FROM pages)""")
def a4_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search results made of pages, 20 in each: titles in numeric entities, links percent-encoded, values labelled."""
    title, job = decode_named(F.regexp_extract("html", r"<title>([^<]*)", 1)), F.col("page_id") + F.lit(40_000_000_000)
    spelled = F.array_join(F.transform(F.regexp_extract_all("t", F.lit("(?s)."), 0), lambda c: F.concat(F.lit("&#x"), F.hex(F.ascii(c)), F.lit(";"))), "")
    href = F.concat(F.lit("/en/job/town/"), F.replace(F.url_encode("t"), F.lit("+"), F.lit("%20")), F.lit("/7/"), "job")
    item = F.concat(
        F.lit('<li>\n <button type="button" data-job-id="'), "job", F.lit('" data-org-id="7">Save</button><a href="'), href, F.lit('" data-job-id="'), "job", F.lit('">\n<h2>'), spelled,
        F.lit('</h2><span class="job-location"><strong>Ort: </strong>Town '), F.col("page_id") % 9, F.lit(", Land &amp; Sea</span>\n<span class=\"job-category\">\n<strong>Art: </strong>Sales\n   and more   \n</span></a></li>"),
    )
    rows = table(spark, sf_dir, "pages").select("page_id", title.alias("t"), job.cast("string").alias("job"))
    lists = rows.groupBy(F.expr("page_id div 20").alias("part")).agg(F.array_join(F.collect_list(item), "").alias("items"))
    return listing_items(lists.select(F.concat(F.lit("<ul>"), "items", F.lit("</ul>")).alias("html")))


@register("a5_link_dedup", f"SELECT page_id, href, min(pos) AS pos, arg_min(label, pos) AS label FROM ({LINKS_SQL}) GROUP BY page_id, href")
def a5_link_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(links(table(spark, sf_dir, "pages")), ["page_id", "href"], ["pos"]).select("page_id", "href", "pos", "label")


@register("a6_decode", f"SELECT page_id, {named_sql("regexp_extract(html, '<title>([^<]*)', 1)")} AS title FROM pages")
def a6_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", r"<title>([^<]*)", 1).alias("t")).select("page_id", decode_entities(F.col("t")).alias("title"))


@register("a7_label_strip", "SELECT c_custkey, n_name || ', ' || r_name AS location FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def a7_label_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _places(spark, sf_dir)
    label = F.element_at(F.array(F.lit("Location"), F.lit("Ubicación"), F.lit("Ort")), (F.col("c_nationkey") % 3 + 1).cast("int"))
    shown = F.concat(F.lit('<span class="l"><strong>'), label, F.lit(":</strong>\n  "), "n_name", F.lit(", "), "r_name")
    return rows.select("c_custkey", strip_label(shown).alias("location"))


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))


@register("a8_page_fields", f"""SELECT page_id, {named_sql("regexp_extract(html, '<title>([^<]*)', 1)")} AS title, {named_sql("regexp_extract(html, '<h1>([^<]*)', 1)")} AS h1,
    regexp_extract(html, '<html[^>]* lang="([^"]*)"', 1) AS lang FROM pages""")
def a8_page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_fields(table(spark, sf_dir, "pages"))


@register("a9_posted_date", "SELECT o_orderkey, o_orderdate::DATE AS posted FROM orders")
def a9_posted_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates are spelled in three ways by their key, and read again."""
    d = F.col("o_orderdate").cast("timestamp")
    local = F.concat_ws(" ", F.dayofmonth(d), F.element_at(F.array(*map(F.lit, MONTHS_ES)), F.month(d)), F.year(d))
    long = F.concat(F.date_format(d, "EEE MMM dd HH:mm:ss"), F.lit(" UTC "), F.year(d))
    raw = F.when(F.col("o_orderkey") % 3 == 0, long).when(F.col("o_orderkey") % 3 == 1, local).otherwise(F.date_format(d, "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select("o_orderkey", posted_date(raw).alias("posted"))


@register("a10_location", """SELECT s_suppkey, CASE WHEN s_suppkey % 3 > 0 THEN s_name END AS locality, CASE WHEN s_suppkey % 3 = 2 THEN n_name END AS region, r_name AS country
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def a10_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    k = F.col("s_suppkey") % 3
    raw = F.concat_ws(", ", F.when(k > 0, F.col("s_name")), F.when(k == 2, F.col("n_name")), F.col("r_name"))
    return rows.select("s_suppkey", split_place(raw).alias("p")).select("s_suppkey", "p.*")


def text_sql(html: str) -> str:
    return "trim(regexp_replace(" + named_sql(f"regexp_replace(regexp_replace(regexp_replace({html}, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g')") + r", '[ \n\t\r]+', ' ', 'g'))"


TEXT_SQL = text_sql("html")


@register("a8_microdata", f"""SELECT page_id, nullif(trim({TITLE_SQL}), '') AS title, 'Town ' || (page_id % 9) AS locality, DATE '2026-01-01' + (page_id % 300)::INT AS posted,
    {text_sql("'<b>Lead</b> ' || regexp_extract(html, '(?s)<article>(.*)</article>', 1)")} AS description FROM pages""")
def a8_microdata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job pages made of pages: properties in attributes and elements, a description of nested elements; some are cut off."""
    day = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("page_id") % 300).cast("int"))
    inner = F.concat(F.lit("<div><div><b>Lead</b></div> <div class=x>"), F.regexp_extract("html", r"(?s)<article>(.*)</article>", 1))
    tail = F.when(F.col("page_id") % 7 == 0, "").otherwise("</div></div></div><div>not part of it</div></body>")
    page = F.concat(
        F.lit('<span itemprop="jobLocation" itemscope><meta itemprop="addressLocality" content="Town '), F.col("page_id") % 9, F.lit('"></span><meta itemprop="datePosted" content="'), day.cast("string"),
        F.lit('"><h1 id="t" itemprop="title">'), F.regexp_extract("html", r"<title>([^<]*)", 1), F.lit('</h1><div itemprop="description" class="d">'), inner, tail,
    )
    found = table(spark, sf_dir, "pages").select("page_id", microdata(page, "title", "addressLocality", "datePosted", nested=("description",)).alias("m"))
    return found.select("page_id", "m.title", F.col("m.addressLocality").alias("locality"), posted_date(F.col("m.datePosted")).alias("posted"), html_to_text(F.col("m.description")).alias("description"))


@register("a11_html_text", f"SELECT page_id, {TEXT_SQL} AS text FROM pages")
def a11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", html_to_text(F.col("html")).alias("text"))


@register("a12_lang_counts", """SELECT regexp_extract(html, '<html[^>]* lang="([^"]*)"', 1) AS lang, count(*) AS n FROM pages GROUP BY 1""")
def a12_lang_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").groupBy(lang_of(F.col("html")).alias("lang")).agg(F.count(F.lit(1)).alias("n"))


@register("a12_lang_elsewhere", """SELECT lang || '-XX' AS tag, lang, count(*) AS n FROM (SELECT regexp_extract(html, '<html[^>]* lang="([^"]*)"', 1) AS lang FROM pages) GROUP BY ALL""")
def a12_lang_elsewhere(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose language stands on a form, with a region."""
    html = F.regexp_replace("html", '<html lang="([a-z]+)">', '<html><form id="f" xml:lang="$1-XX" lang="$1-XX"></form>')
    tags = table(spark, sf_dir, "pages").select(lang_of(html).alias("tag"))
    return tags.groupBy("tag", primary_language(F.col("tag")).alias("lang")).agg(F.count(F.lit(1)).alias("n"))


@register("a13_agreement", f"""SELECT coalesce(nullif(lang, ''), seg) AS lang, count(*) AS n, count(*) FILTER (title = h1) AS n_titles, count(*) FILTER (lang = seg) AS n_langs FROM (
    SELECT regexp_extract(html, '<title>([^<]*)', 1) AS title, regexp_extract(html, '<h1>([^<]*)', 1) AS h1, regexp_extract(html, '<html[^>]* lang="([^"]*)"', 1) AS lang, regexp_extract(url, '^[a-z]+://[^/?#]+/([a-z]+)/', 1) AS seg FROM pages) GROUP BY 1""")
def a13_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    lang, langs_agree = first_of(F.nullif(lang_of(F.col("html")), F.lit("")), F.regexp_extract("url", r"^[a-z]+://[^/?#]+/([a-z]+)/", 1))
    _, titles_agree = first_of(F.regexp_extract("html", r"<title>([^<]*)", 1), F.regexp_extract("html", r"<h1>([^<]*)", 1))
    rows = pages.select(lang.alias("lang"), langs_agree.alias("l"), titles_agree.alias("t"))
    return rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if("t").alias("n_titles"), F.count_if("l").alias("n_langs"))


@register("b9_level", """SELECT level, count(*) AS n FROM (SELECT CASE p_size % 6 WHEN 0 THEN 'intern' WHEN 1 THEN 'junior' WHEN 2 THEN 'senior' WHEN 3 THEN 'lead' WHEN 4 THEN 'manager' ELSE 'mid' END AS level FROM part) GROUP BY level""")
def b9_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles are made from parts: a word of level by size, then the part's name."""
    words = [F.lit(w) for w in ("Internship:", "Graduate", "Sr.", "Principal", "Director of", "Internal")]
    title = F.concat_ws(" ", F.element_at(F.array(*words), F.col("p_size") % 6 + 1), F.initcap("p_name"))
    return table(spark, sf_dir, "part").groupBy(seniority(title).alias("level")).agg(F.count(F.lit(1)).alias("n"))


LEVEL_SQL = "CASE p_size % 6 WHEN 0 THEN 'intern' WHEN 1 THEN 'junior' WHEN 2 THEN 'senior' WHEN 3 THEN 'lead' WHEN 4 THEN 'manager' ELSE 'mid' END"


@register("b9_capped", f"""SELECT p_brand, p_partkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rank FROM (SELECT *, {LEVEL_SQL} AS level FROM part) WHERE level IN ('senior', 'lead')) WHERE rank <= 3""")
def b9_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each brand's senior titles the three with the highest pay."""
    words = [F.lit(w) for w in ("Internship:", "Graduate", "Sr.", "Principal", "Director of", "Internal")]
    title = F.concat_ws(" ", F.element_at(F.array(*words), F.col("p_size") % 6 + 1), F.initcap("p_name"))
    senior = table(spark, sf_dir, "part").filter(seniority(title).isin("senior", "lead")).select("p_brand", "p_partkey", "p_retailprice")
    return capped(senior, "p_brand", [F.desc("p_retailprice"), F.asc("p_partkey")], 3).select("p_brand", "p_partkey", "rank")


@register("b13_kind", """SELECT kind, count(*) AS n FROM (SELECT CASE p_size % 6 WHEN 0 THEN 'full_time' WHEN 1 THEN 'part_time' WHEN 2 THEN 'contract' WHEN 3 THEN 'internship' WHEN 4 THEN 'temporary' END AS kind FROM part) GROUP BY kind""")
def b13_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = [F.lit(w) for w in ("Full-time,", "part time:", "CONTRACTOR", "Trainee (full time)", "Seasonal", "Contractual")]
    text = F.concat_ws(" ", F.lit("A"), F.element_at(F.array(*words), F.col("p_size") % 6 + 1), "p_name")
    return table(spark, sf_dir, "part").groupBy(employment_kind(text).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@register("b13_range", """SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_size * 12 WHEN 1 THEN p_size WHEN 2 THEN p_size * 12 END AS low, CASE p_size % 4 WHEN 1 THEN p_size WHEN 2 THEN (p_size + 2) * 12 END AS high FROM part""")
def b13_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, k = F.col("p_size"), F.col("p_size") % 4
    raw = F.when(k == 0, F.concat(n, F.lit("+ years of work"))).when(k == 1, F.concat(F.lit("at least "), n, F.lit(" months"))).when(k == 2, F.concat(n, F.lit(" to "), n + 2, F.lit(" yrs"))).otherwise("none asked")
    return table(spark, sf_dir, "part").select("p_partkey", experience(raw).alias("e")).select("p_partkey", "e.*")


@register("b13_months", "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_size * 12 WHEN 1 THEN p_size WHEN 2 THEN p_size * 12 END AS months FROM part")
def b13_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, k = F.col("p_size"), F.col("p_size") % 4
    raw = F.when(k == 0, F.concat(n, F.lit("+ years of work"))).when(k == 1, F.concat(F.lit("at least "), n, F.lit(" months"))).when(k == 2, F.concat(n, F.lit(" - "), n + 2, F.lit(" yrs"))).otherwise("none asked")
    return table(spark, sf_dir, "part").select("p_partkey", months_of_experience(raw).alias("months"))


@register("b14_salary", """SELECT p_partkey, round(p_retailprice, 2)::DECIMAL(18,2) AS low, CASE WHEN p_partkey % 2 = 0 THEN (round(p_retailprice, 2) + 500)::DECIMAL(18,2) ELSE round(p_retailprice, 2)::DECIMAL(18,2) END AS high,
    'USD' AS currency, CASE WHEN p_partkey % 2 = 0 THEN 'month' ELSE 'year' END AS period, (round(p_retailprice, 2)::DECIMAL(18,2) * CASE WHEN p_partkey % 2 = 0 THEN 12 ELSE 1 END)::DECIMAL(18,2) AS yearly FROM part""")
def b14_salary(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = lambda more: F.concat(F.lit("$"), F.format_number(F.col("p_retailprice") + more, 2))
    raw = F.when(F.col("p_partkey") % 2 == 0, F.concat(price(0), F.lit(" - "), price(500), F.lit(" per month"))).otherwise(F.concat(F.lit("Pay: "), price(0), F.lit(" a year")))
    return table(spark, sf_dir, "part").select("p_partkey", salary(raw).alias("s")).select("p_partkey", "s.*")
