import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from jobsluice.functions.fields import employment_kind, experience, months_of_experience, posted_date, salary, seniority, split_place
from jobsluice.functions.text import decode_entities, decode_percent, html_to_text, strip_label
from jobsluice.operators import checks, dedup, health, location, snapshots, tagging
from jobsluice.plans import stream_queries  # noqa: F401 (registers its queries)
from jobsluice.plans.registry import ORACLES
from jobsluice.sources.objects import dataset_pairs, object_path, read_dataset, write_dataset
from jobsluice.sources.pages import explode_sitemap, first_of, inner_html, lang_of, listing_items, microdata, page_posting_id, posting_id, primary_language
from jobsluice.streaming.intake import new_rows
from jobsluice.streaming.stateful import dedup_with_ttl, lifecycle_stream


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v")).alias("r")).first()["r"]


def test_sitemap(spark):
    xml = """<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">
    <url><loc>https://a.example/x/job/b/123/</loc><lastmod>2026-09-12</lastmod><changefreq>daily</changefreq><priority>0.5</priority></url>
    <url><loc>https://a.example/job/c/456/</loc><lastmod>2026-09-13</lastmod></url></urlset>"""
    rows = explode_sitemap(spark.createDataFrame([(xml,)], "xml string")).collect()
    assert [tuple(r) for r in rows] == [("https://a.example/x/job/b/123/", datetime.date(2026, 9, 12), "daily", 0.5), ("https://a.example/job/c/456/", datetime.date(2026, 9, 13), None, None)]


def test_listing(spark):
    html = """<ul><li data-job-id="90123456789" data-org-id="7"><a href="/en/job/a%20b/x%C3%A9&amp;y/7/90123456789"><h2>&#x4E2D;&#65; &amp; B</h2>
    <span class="job-location"><strong>Where:</strong> Oslo, Norway</span><span class="job-category"><strong>Kind:</strong> Data
      and more</span></a></li><li>cut"""
    (row,) = listing_items(spark.createDataFrame([(html,)], "html string")).collect()
    assert tuple(row) == ("90123456789", "7", "/en/job/a b/xé&y/7/90123456789", "中A & B", "Oslo, Norway", "Data and more")


def test_microdata_of_a_cut_page(spark):
    html = '<meta itemprop="addressCountry" content="NO"><span itemprop="title">A &amp; B</span><p itemprop="x'
    row = one(spark, lambda c: microdata(c, "addressCountry", "title", "missing"), html)
    assert tuple(row) == ("NO", "A & B", None)


@pytest.mark.parametrize(
    ("html", "inner"),
    [
        ('<p><span itemprop="d"><b>x</b><span>y<span>z</span></span> w</span><span>no</span>', "<b>x</b><span>y<span>z</span></span> w"),
        ('<span itemprop="d">a<span>b</span>', "a<span>b</span>"),
        ('<SPAN itemprop="d"></span>', ""),
        ('<div itemprop="d">a<divx>b</div>c', "a<divx>b"),
        ("<p>none</p>", None),
        (None, None),
    ],
)
def test_nested_elements(spark, html, inner):
    assert one(spark, lambda c: inner_html(c, r'<(\w+)[^>]*itemprop="d"[^>]*>'), html) == inner


def test_postings_urls(spark):
    urls = ["https://h.example/Place/job/A-Role/123/", "/job/A-Role/123", "https://h.example/en/job/x/y%20z/9/50000000001", "https://h.example/de/77?x", "https://h.example/about/job", "/en/job/x/y/z/5", None]
    assert [one(spark, posting_id, u) for u in urls] == [123, 123, 50000000001, 77, None, None, None]
    pages = ['<form action="/s/?l=x&amp;jobid=50000000001">', '<a href="/t/apply/12/?l=x">', "<p>"]
    assert [one(spark, page_posting_id, p) for p in pages] == [50000000001, 12, None]


def test_language_of_a_page(spark):
    pages = ['<html class="x" lang="fr">', '<html><p lang="de">', '<html><form a="1" xml:lang="pt-BR" lang="pt-BR">', "<html>", None]
    assert [one(spark, lang_of, p) for p in pages] == ["fr", "de", "pt-BR", "", None]
    assert one(spark, primary_language, "pt-BR") == "pt"


@pytest.mark.parametrize("raw", ["Mon Mar 03 09:30:00 UTC 2025", "3 mar 2025", "2025-03-03"])
def test_posted_date(spark, raw):
    assert one(spark, posted_date, raw) == datetime.date(2025, 3, 3)


def test_posted_date_of_nonsense(spark):
    assert [one(spark, posted_date, x) for x in ("soon", "", "31 feb 2025", "2025-13-01", None)] == [None] * 5


def test_text(spark):
    assert one(spark, decode_entities, "&#x5317;&#20140; &amp;lt; &lt;") == "北京 &lt; <"
    assert one(spark, decode_percent, "a%20b%C3%A9+c") == "a bé+c"
    assert one(spark, decode_percent, "100%") == "100%"
    assert one(spark, strip_label, "<b><strong>Ort:</strong>\n Oslo,  Norway") == "Oslo, Norway"
    assert one(spark, html_to_text, "<p>a<script>x<y</script><!-- no --> b&nbsp;</p>") == "a b"


def test_fields(spark):
    assert tuple(one(spark, split_place, "Bergen, Vestland, NO")) == ("Bergen", "Vestland", "NO")
    assert tuple(one(spark, split_place, "NO")) == (None, None, "NO")
    assert [tuple(one(spark, experience, x)) for x in ("3+ years", "18 months", "1 to 2 yrs", "none")] == [(36, None), (18, 18), (12, 24), (None, None)]
    assert [one(spark, employment_kind, x) for x in ("Part-time job", "A permanent role", "contract, full time", "any", None)] == ["part_time", "full_time", "contract", None, None]
    assert [one(spark, months_of_experience, x) for x in ("3+ years", "18 months", "1-2 yrs", "none")] == [36, 18, 12, None]
    low, high, currency, period, yearly = one(spark, salary, "€1,200.50 - €1,500 per month")
    assert (float(low), float(high), currency, period, float(yearly)) == (1200.5, 1500.0, "EUR", "month", 14406.0)
    assert one(spark, salary, "good pay")["low"] is None
    assert [one(spark, seniority, t) for t in ("Sr. Engineer", "Senior Lead", "Internal Auditor", "Summer Internship")] == ["senior", "lead", "mid", "intern"]


def test_first_of(spark):
    rows = spark.createDataFrame([("a", "a"), (None, "b"), ("a", "b"), (None, None)], "x string, y string")
    value, agree = first_of(F.col("x"), F.col("y"))
    assert [tuple(r) for r in rows.select(value, agree).collect()] == [("a", True), ("b", True), ("a", False), (None, True)]


def test_country_longest_alias(spark):
    aliases = spark.createDataFrame([("Perú", "PE"), ("united states", "US"), ("states", "XX"), ("Cesko", "CZ"), ("Łódź", "PL"), (" , ", "YY")], "alias string, country string")
    places = [(1, "Lima, PERU"), (2, "Ohio, the United  States (east)"), (3, "Moon"), (4, None), (5, "Brno, Česko"), (6, "Lo\u0301dz\u0301 x"), (7, "united, states"), (8, "Per\u0075\u0301"), (9, "")]
    rows = spark.createDataFrame(places, "k int, place string")
    found = {r["k"]: r["country"] for r in location.resolve_country(rows, "place", aliases).collect()}
    assert {k: v for k, v in found.items() if k != 6} == {1: "PE", 2: "US", 3: None, 4: None, 5: "CZ", 7: "XX", 8: "PE", 9: None}


def test_null_keys_are_compared(spark):
    old = spark.createDataFrame([(None, "a"), (1, "b"), (2, "c")], "k int, v string")
    new = spark.createDataFrame([(None, "a"), (1, "x")], "k int, v string")
    assert {tuple(r) for r in snapshots.lifecycle(old, new, ["k"]).collect()} == {(None, "kept"), (1, "changed"), (2, "removed")}


def test_health_counts_null_sources_and_values(spark):
    rows = [(1, None, 1.0), (1, None, None), (1, "a", 4.0), (1, "a", 2.0), (1, "a", 2.0), (2, "a", None)]
    events = spark.createDataFrame(rows, "w int, s string, v double")
    got = {(r["start"], r["s"]): tuple(r)[2:] for r in health.health(events, F.col("w"), "s", F.col("v") > 3, "v", top=F.col("v")).collect()}
    assert got == {(1, None): (2, 0.0, 1.0, 1.0, 1.0), (1, "a"): (3, 0.333333, 2.0, 3.8, 4.0), (2, "a"): (1, 0.0, None, None, None)}


def test_rules_from_a_table(spark):
    table = spark.createDataFrame([tuple(tagging.Rule("b", 2, "data")), tuple(tagging.Rule("a", 1, "été", exclude="hiver"))], "tag string, priority int, include string, exclude string, second string")
    rules = tagging.rules_of(table)
    rows = spark.createDataFrame([("big data, été",), ("été hiver",), ("datas étés",), (None,)], "t string")
    tags = tagging.tags(rules, F.col("t"))
    assert [r[0] for r in rows.select(tags).collect()] == [["a", "b"], [], [], []]
    assert [r[0] for r in rows.select(tagging.primary(rules, tags)).collect()] == ["a", "general", "general", "general"]


def test_snapshots(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(2, None), (3, "x"), (4, "d")], "k int, v string")
    assert {tuple(r) for r in snapshots.lifecycle(old, new, ["k"]).collect()} == {(1, "removed"), (2, "kept"), (3, "changed"), (4, "added")}
    assert snapshots.differences(old, old, ["k"]).count() == 0


def test_valid_and_quarantined_are_all(spark):
    rows = spark.createDataFrame([(1, "x"), (2, None), (None, "y")], "k int, v string")
    valid, bad = checks.validate(rows, {"has_k": F.col("k").isNotNull(), "has_v": F.col("v") != ""})
    assert valid.count() + bad.count() == 3
    assert {tuple(r["reasons"]) for r in bad.collect()} == {("has_k",), ("has_v",)}


def test_seen_keys_may_be_null(spark):
    rows = spark.createDataFrame([(1,), (None,), (2,)], "k int")
    assert [r["k"] for r in dedup.drop_seen(rows, rows.filter("k is null or k = 1"), ["k"]).collect()] == [2]


def test_objects(spark, tmp_path):
    assert object_path("b", "/x/y/") == "s3a://b/x/y"
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, r string")
    for side in ("l", "r"):
        write_dataset(rows, f"file://{tmp_path}/{side}/d", ("r",))
    write_dataset(rows, f"file://{tmp_path}/r/extra")
    pairs = dataset_pairs(spark, f"file://{tmp_path}/l", f"file://{tmp_path}/r")
    assert [(n, left is None) for n, left, _ in pairs] == [("d", False), ("extra", True)]
    assert [tuple(r) for r in snapshots.parity_report(spark, pairs, {"d": ["k"]}).collect()] == [("extra", "right_only", 2)]
    assert read_dataset(spark, f"file://{tmp_path}/l/d").count() == 2


def test_stream_in_slices_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts", "user_id")
    batch = {r["event_id"] for r in dedup.drop_within_ttl(events, F.col("user_id"), "ts", 7 * 86400, "event_id").collect()}
    bounds = ["2024-01-01", "2024-01-11", "2024-01-21", "2024-02-11"]
    for a, b in zip(bounds, bounds[1:]):
        events.filter((F.col("ts") >= a) & (F.col("ts") < b)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        dedup_with_ttl(new_rows(spark, f"{tmp_path}/in", events.schema, 1), "user_id", "ts", 7 * 86400, f"{tmp_path}/kept", f"{tmp_path}/checkpoint")
    assert {r["event_id"] for r in spark.read.parquet(f"{tmp_path}/kept/out").collect()} == batch


@pytest.mark.parametrize("files", [1, 2, 5])
def test_lifecycle_whatever_the_batches(spark, tmp_path, files):
    days = {1: [0, 0, 3, 11, 12, 50, 51], 2: [0.5, 9, 60], 3: [45], 4: [0, 59.5, 60], 5: [2, 30.5], 6: [52, 52.5, 59.9]}
    rows = sorted((datetime.datetime(2024, 1, 1) + datetime.timedelta(days=d), key) for key, times in days.items() for d in times)
    rows = [(i, t, key) for i, (t, key) in enumerate(rows)]
    schema, size = "event_id long, ts timestamp_ntz, user_id long", -(-len(rows) // files)
    for first in range(0, len(rows), size):
        spark.createDataFrame(rows[first : first + size], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    events = new_rows(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema, 1)
    lifecycle_stream(events, "user_id", "ts", 7 * 86400, 28 * 86400, 60, f"{tmp_path}", f"{tmp_path}/checkpoint")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/in/*.parquet'")
    want = con.execute(ORACLES["b21_lifecycle_events"]).fetchall()
    assert {r[1] for r in want} == {"new", "seen", "back", "expired"}
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").select("key", "event", "micros", "n").collect())) == sorted(want)


def test_state_of_forgotten_keys_goes(spark, tmp_path):
    """Rows late within the delay do not set a key back, later ones are left out, and keys beyond their time are dropped."""
    day = lambda d: datetime.datetime(2024, 1, 1) + datetime.timedelta(days=d)
    schema = "event_id long, ts timestamp, user_id string"
    batches = [[(1, day(0), "a"), (2, day(0), None), (3, None, "a")], [(4, day(5), "a"), (5, day(4.9999), "a")], [(6, day(4), "a"), (7, day(40), None), (8, day(40), "b")]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = new_rows(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema)
        dedup_with_ttl(stream, "user_id", "ts", 7 * 86400, f"{tmp_path}/kept", f"{tmp_path}/checkpoint")
    assert sorted(r["event_id"] for r in spark.read.parquet(f"{tmp_path}/kept/out").collect()) == [1, 2, 7, 8]
    assert {r["key"] for r in spark.read.parquet(f"{tmp_path}/kept/state").filter("batch = 2").collect()} == {None, "b"}
