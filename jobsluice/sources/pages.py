"""Landed pages and sitemaps as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsluice.functions.text import decode_entities, decode_named, decode_percent

URL = T.StructType([T.StructField("loc", T.StringType()), T.StructField("lastmod", T.DateType()), T.StructField("changefreq", T.StringType()), T.StructField("priority", T.DoubleType())])
URLSET = T.StructType([T.StructField("url", T.ArrayType(URL))])
#: Forms of postings' urls, each with one group, the posting's number: /[section/]job/slug/number/,
#: /language/job/place/slug/organisation/number (absolute or relative), and /language/number.
POSTINGS = (
    r"^(?:[a-z]+://[^/?#]+)?(?:/[^/?#]+)?/job/[^/?#]+/([0-9]+)/?(?:[?#]|$)",
    r"^(?:[a-z]+://[^/?#]+)?/[A-Za-z]{2}(?:-[A-Za-z]{2})?/job/[^/?#]+/[^/?#]+/[0-9]+/([0-9]+)/?(?:[?#]|$)",
    r"^[a-z]+://[^/?#]+/(?:en|fr|de|es)/([0-9]+)",
)


def explode_sitemap(sitemaps: DataFrame, xml: str = "xml") -> DataFrame:
    """loc, lastmod, changefreq, priority of each url of each sitemap; the last two are often missing."""
    rows = sitemaps.select(F.explode(F.from_xml(F.col(xml), URLSET)["url"]).alias("u"))
    return rows.select("u.*")


def posting_urls(pages: DataFrame, forms: tuple[str, ...] = POSTINGS, url: str = "url") -> DataFrame:
    """The rows whose url is that of a posting, in any of the forms."""
    return pages.filter(F.col(url).rlike("|".join(forms)))


def posting_id(url: Column, forms: tuple[str, ...] = POSTINGS) -> Column:
    """The number in a posting's url, as bigint: such ids exceed 32 bits. The first form that fits counts."""
    return F.coalesce(*(F.regexp_extract(url, form, 1).try_cast("bigint") for form in forms))


def page_posting_id(html: Column) -> Column:
    """The posting's number on its own page: a parameter of its forms, else a part of its application link."""
    forms = (r"[?&;]jobid=([0-9]+)", r'href="[^"]*/apply/([0-9]+)/')
    return F.coalesce(*(F.regexp_extract(html, form, 1).try_cast("bigint") for form in forms))


def host_of(url: Column) -> Column:
    return F.regexp_extract(url, r"://([^/?#]*)", 1)


def lang_of(html: Column) -> Column:
    """The page's language tag as written: of ``<html>``, else of the first element that names one; else empty."""
    named = F.regexp_extract(html, r'<[A-Za-z][^>]*? (?:xml:)?lang="([^"]+)"', 1)
    return F.coalesce(F.nullif(F.regexp_extract(html, r'<html[^>]* lang="([^"]*)"', 1), F.lit("")), named)


def primary_language(tag: Column) -> Column:
    """``es`` of ``es-ES`` or ``es_ES``, in lower case."""
    return F.lower(F.regexp_extract(tag, r"^[A-Za-z]*", 0))


def links(pages: DataFrame) -> DataFrame:
    """page_id, pos, href, label of each anchor; anchors are cut out once, their parts taken from the cuts."""
    anchors = F.regexp_extract_all("html", F.lit(r'(<a href="[^"]*">[^<]*</a>)'), 1)
    rows = pages.select("page_id", F.posexplode(anchors).alias("pos", "a"))
    return rows.select("page_id", F.col("pos").cast("long").alias("pos"), F.regexp_extract("a", r'href="([^"]*)"', 1).alias("href"), decode_named(F.regexp_extract("a", r">([^<]*)<", 1)).alias("label"))


def listing_items(listings: DataFrame, html: str = "html") -> DataFrame:
    """job_id, org_id, href, title, location, category of each ``<li>`` item of a search result, decoded.

    An item names its number more than once; the first counts.
    """
    items = F.regexp_extract_all(F.col(html), F.lit(r"(?s)(<li[^>]*>.*?</li>)"), 1)
    rows = listings.select(F.explode(items).alias("i"))
    part = lambda p: F.nullif(F.trim(F.regexp_replace(F.regexp_extract("i", p, 1), r"\s+", " ")), F.lit(""))
    return rows.select(
        part(r'data-job-id="(\d+)"').alias("job_id"),
        part(r'data-org-id="(\d+)"').alias("org_id"),
        decode_percent(decode_named(part(r'href="([^"]*)"'))).alias("href"),
        decode_entities(part(r"(?s)<h\d[^>]*>(.*?)</h\d>")).alias("title"),
        decode_entities(part(r"(?s)class=\"[^\"]*location[^\"]*\"[^>]*>(?:\s*<strong>[^<]*</strong>)?(.*?)</")).alias("location"),
        decode_entities(part(r"(?s)class=\"[^\"]*category[^\"]*\"[^>]*>(?:\s*<strong>[^<]*</strong>)?(.*?)</")).alias("category"),
    )


def inner_html(html: Column, opening: str) -> Column:
    """What stands in the first element whose opening tag fits the pattern, tags of nested elements included.

    Closing tags of the element's name are counted against opening ones. On a page that is cut off before the element
    ends, what is left of it; null where there is no such element.
    """
    rest = F.regexp_extract(html, rf"(?s){opening}(.*)$", 2)
    name = F.regexp_extract(html, opening, 1)
    parts = F.split(rest, F.concat(F.lit("(?i)</"), name, F.lit(r"\s*>")))
    opened = F.transform(parts, lambda p: F.size(F.split(p, F.concat(F.lit("(?i)<"), name, F.lit(r"(?=[\s>])")))) - 1)
    start = F.struct(F.lit(0).alias("open"), F.lit(0).alias("taken"), F.lit(False).alias("done"))
    walk = F.aggregate(
        opened,
        start,
        lambda s, n: F.when(s["done"], s).otherwise(F.struct((s["open"] + n).alias("open"), (s["taken"] + 1).alias("taken"), (s["open"] + n == s["taken"]).alias("done"))),
        lambda s: s["taken"],
    )
    return F.when(html.rlike(opening), F.call_function("array_join", F.slice(parts, 1, walk), F.concat(F.lit("</"), name, F.lit(">"))))


def microdata(html: Column, *properties: str, nested: tuple[str, ...] = ()) -> Column:
    """struct of ``itemprop`` values: of a ``content`` attribute, else of the element's text; null where missing.

    The properties of ``nested`` hold further elements, and come as the html inside.
    """
    fields = []
    for p in properties:
        content = F.regexp_extract(html, rf'<[^>]*itemprop="{p}"[^>]*content="([^"]*)"', 1)
        text = F.regexp_extract(html, rf'(?s)<[^>]*itemprop="{p}"[^>]*>([^<]*)<', 1)
        fields.append(decode_entities(F.coalesce(F.nullif(content, F.lit("")), F.nullif(F.trim(text), F.lit("")))).alias(p))
    inner = [inner_html(html, rf'<(\w+)[^>]*itemprop="{p}"[^>]*>').alias(p) for p in nested]
    return F.struct(*fields, *inner)


def page_fields(pages: DataFrame) -> DataFrame:
    """page_id, title, h1, lang; the html itself goes no further."""
    return pages.select("page_id", decode_named(F.regexp_extract("html", r"<title>([^<]*)", 1)).alias("title"), decode_named(F.regexp_extract("html", r"<h1>([^<]*)", 1)).alias("h1"), lang_of(F.col("html")).alias("lang"))


def first_of(*values: Column) -> tuple[Column, Column]:
    """The first value that is not null, and whether all that are not null agree."""
    given = F.filter(F.array(*values), lambda v: v.isNotNull())
    return F.coalesce(*values), F.size(F.array_distinct(given)) <= 1
