"""Lines with rejects, sitemap files, publishing, localised dates, feeds as a table, malformed pages."""

import datetime
import gzip
import random

import pytest
from pyspark.sql import functions as F

from jobsluice.functions.fields import MONTHS, localised_date
from jobsluice.functions.text import html_to_text
from jobsluice.operators import feeds
from jobsluice.sources.landed import read_indexed, read_lines, read_sitemaps
from jobsluice.sources.objects import publish, read_published

DAY = datetime.date(2026, 5, 1)
FEED = "feed string, lang string, tag string, low long, high long, since date, until date, most int"
ROW = "id long, lang string, tags array<string>, size long, day date, `extra feed` string"


def test_lines_of_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1, "b": "x\\ny"}\n{"a": "no"}\n{"a": 2\n\n{"b": "only", "c": 9}\nnull\n')
    rows = read_lines(spark, f"file://{tmp_path}/a.json", "json", "a long, b string").collect()
    assert sorted((r["rejected"] for r in rows if r["rejected"]), key=str) == ["null", '{"a": "no"}', '{"a": 2']
    assert [(r["a"], r["b"]) for r in rows if not r["rejected"]][:2] == [(1, "x\ny"), (None, "only")]
    lines = read_lines(spark, f"file://{tmp_path}/a.json", "json", "a long, b string")
    assert lines.filter("rejected is not null").count() == 3 and lines.filter("rejected is null").select("b").count() == 2
    (tmp_path / "empty.json").write_text("")
    assert read_lines(spark, f"file://{tmp_path}/empty.json", "json", "a long").collect() == []


def test_lines_of_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"x, ""y"""\nword,z\n2\n3,c,d\n,\n')
    read = lambda **o: read_lines(spark, f"file://{tmp_path}/a.csv", "csv", "a long, b string", header=True, **o)
    rows = read().collect()
    assert [(r["a"], r["b"]) for r in rows if not r["rejected"]] == [(1, 'x, "y"'), (None, None)]
    assert sorted(r["rejected"] for r in rows if r["rejected"]) == ["2", "3,c,d", "word,z"]
    # what is selected does not change which lines are good
    assert read().filter("rejected is null").select("b").count() == 2
    (tmp_path / "b.csv").write_text('1,"two\nlines"\n')
    assert read_lines(spark, f"file://{tmp_path}/b.csv", "csv", "a long, b string", multiLine=True).first()["b"] == "two\nlines"
    with pytest.raises(ValueError, match="rejected"):
        read_lines(spark, "x", "csv", "rejected string")
    with pytest.raises(ValueError, match="json or csv"):
        read_lines(spark, "x", "orc", "a long")


def test_sitemap_files(spark, tmp_path):
    head = '<?xml version="1.0" encoding="UTF-8"?>\n'
    url = lambda loc, rest="": f"<url><loc>{loc}</loc>{rest}</url>"
    full = head + f'<s:urlset xmlns:s="http://www.sitemaps.org/schemas/sitemap/0.9">{url("http://a/?x=1&amp;y=2", "<lastmod>2026-01-02</lastmod><priority>0.5</priority>")}{url("http://b")}</s:urlset>'
    (tmp_path / "one.xml").write_text(full)
    with gzip.open(tmp_path / "two.xml.gz", "wt") as f:
        f.write(head + f'<urlset>{url("http://c", "<lastmod>soon</lastmod><priority>high</priority>")}</urlset>')
    (tmp_path / "none.xml").write_text(head + "<urlset></urlset>")
    maps = [f"file://{tmp_path}/{n}" for n in ("one.xml", "two.xml.gz", "none.xml")]
    rows = {r["loc"]: r for r in read_sitemaps(spark, maps).collect()}
    assert set(rows) == {"http://a/?x=1&y=2", "http://b", "http://c"}
    assert rows["http://a/?x=1&y=2"]["lastmod"] == datetime.date(2026, 1, 2) and rows["http://a/?x=1&y=2"]["priority"] == 0.5
    assert rows["http://b"]["lastmod"] is None and rows["http://c"]["lastmod"] is None
    index = tmp_path / "index.xml"
    index.write_text(head + "<sitemapindex>" + "".join(f"<sitemap><loc> {m} </loc></sitemap>" for m in [*maps, maps[1]]) + "<sitemap></sitemap></sitemapindex>")
    assert read_indexed(spark, f"file://{index}").count() == 3
    index.write_text(head + "<sitemapindex></sitemapindex>")
    assert read_indexed(spark, f"file://{index}").collect() == []


def test_published_rows_change_at_once(spark, tmp_path):
    path = f"file://{tmp_path}/set"
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    publish(spark.range(3), path)
    before = read_published(spark, path)
    publish(before.select(F.col("id") + 10), path)
    assert sorted(r[0] for r in read_published(spark, path).collect()) == [10, 11, 12]
    assert before.count() == 3  # who reads the version before is not disturbed
    publish(spark.range(1), path, last_step=False)
    assert read_published(spark, path).count() == 3
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        publish(spark.range(1).select(F.expr("1 / id").alias("id")), path)
    assert read_published(spark, path).count() == 3
    publish(spark.range(7), path)
    assert read_published(spark, path).count() == 7
    assert len(list((tmp_path / "set" / "_versions").glob("0*"))) == 2
    publish(spark.range(0), path)
    assert read_published(spark, path).count() == 0


def test_localised_dates(spark):
    given = [
        ("3 mars 2025", "fr", (2025, 3, 3)), ("3. März 2025", "de", (2025, 3, 3)), ("3 de marzo de 2025", "es", (2025, 3, 3)), ("March 3, 2025", "en", (2025, 3, 3)),
        ("14 juillet 2025", "fr", (2025, 7, 14)), ("14 juin 2025", "FR", (2025, 6, 14)), ("1 août 2025", "fr", (2025, 8, 1)), ("31 dezembro 2024", "pt", (2024, 12, 31)), ("9 DEZ 2024", "pt", (2024, 12, 9)),
        ("2 gennaio 2025", "it", (2025, 1, 2)), ("31 feb 2025", "en", None), ("3 mars 2025", "xx", None), ("3 brumaire 2025", "fr", None), ("mars", "fr", None), ("", "fr", None), (None, "fr", None), ("3 mars 2025", None, None),
    ]
    rows = spark.createDataFrame([(i, raw, lang) for i, (raw, lang, _) in enumerate(given)], "i int, raw string, lang string")
    found = {r["i"]: r["d"] for r in rows.select("i", localised_date(F.col("raw"), F.col("lang")).alias("d")).collect()}
    assert [found[i] for i in range(len(given))] == [d and datetime.date(*d) for _, _, d in given]
    assert all(len(set(names)) == 12 for names in MONTHS.values())


def made_feeds(rng, n):
    out = []
    for k in range(n):
        low = rng.choice([-5, 0, 1, 7, 100, 1 << 40])
        out.append((f"f{k}", rng.choice([None, "en", "de", "*"]), rng.choice([None, "a", "b", "=a"]), low, low + rng.choice([0, 1, 50, 1 << 41]), rng.choice([None, DAY]), rng.choice([None, DAY]), rng.choice([0, 1, 3])))
    return out


def made_rows(rng, n):
    pick = rng.choice
    return [(k, pick(["en", "en", "en", "de", "*", None]), pick([None, [], ["a"], ["a", "a", "b"], ["=a", None]]), pick([None, -3, 0, 1, 7, 8, 120, 1 << 40]), pick([None, DAY, DAY - datetime.timedelta(1)]), None) for k in range(n)]


def plain_routes(rows, given):
    out = []
    for feed, lang, tag, low, high, since, until, most in given:
        fit = [
            r for r in rows
            if r[3] is not None and low <= r[3] < high and (lang is None or r[1] == lang) and (tag is None or tag in (r[2] or []))
            and (since is None or (r[4] and r[4] >= since)) and (until is None or (r[4] and r[4] < until))
        ]
        out += [(feed, k, r[0]) for k, r in enumerate(sorted(fit, key=lambda r: r[0])[:most], 1)]
    return sorted(out)


@pytest.mark.parametrize("most_broadcast", [1 << 20, 0])
def test_feeds_of_a_table(spark, most_broadcast):
    rng = random.Random(3)
    given, rows = made_feeds(rng, 60), made_rows(rng, 150)
    df = spark.createDataFrame(rows, ROW)
    route = lambda df, given: feeds.route_table(df, spark.createDataFrame(given, FEED), *[F.col(c) for c in ("lang", "tags", "size", "day")], ["id"], most_broadcast)
    found = route(df, given)
    assert sorted((r["feed"], r["rank"], r["id"]) for r in found.collect()) == plain_routes(rows, given)
    assert found.columns == ["feed", *df.columns, "rank"]
    assert route(df, []).collect() == [] and route(df.limit(0), given).collect() == []


def test_no_feed_is_part_of_the_plan(spark):
    given = made_feeds(random.Random(4), 50)
    df = spark.createDataFrame(made_rows(random.Random(5), 20), ROW)
    table = spark.createDataFrame(given, FEED)
    found = feeds.route_table(df, table, *[F.col(c) for c in ("lang", "tags", "size", "day")], ["id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert not any(f"f{k}" in plan.replace("of", "") for k in range(10, 50))


def joined_rows(plan):
    """The rows that each join of a plan that has run gave."""
    name = plan.nodeName()
    if name in ("AdaptiveSparkPlan", "ResultQueryStage"):
        return joined_rows(plan.executedPlan() if name == "AdaptiveSparkPlan" else plan.plan())
    below = [plan.plan()] if "QueryStage" in name else [plan.child()] if name.startswith("Reused") else [plan.children().apply(i) for i in range(plan.children().size())]
    own = [plan.metrics().get("numOutputRows").get().value()] if name.endswith("Join") else []
    return own + [n for x in below for n in joined_rows(x)]


def test_feeds_and_rows_are_not_paired(spark):
    """Every feed fits most rows; what is joined grows with rows and feeds, not with their product."""
    n_rows, n_feeds = 3000, 600
    rows = [(k, "en", ["a"], k % 1000, DAY + datetime.timedelta(k % 5), None) for k in range(n_rows)]
    given = [(f"f{k}", "en", None, k % 50, 900 + k % 99, None if k % 4 else DAY, None if k % 5 else DAY + datetime.timedelta(4), 1 + k % 3) for k in range(n_feeds)]
    found = feeds.route_table(spark.createDataFrame(rows, ROW), spark.createDataFrame(given, FEED), *[F.col(c) for c in ("lang", "tags", "size", "day")], ["id"], 0)
    assert sorted((r["feed"], r["rank"], r["id"]) for r in found.collect()) == plain_routes(rows, given)
    joined = joined_rows(found._jdf.queryExecution().executedPlan())
    # a row is in a block for each level of sizes and each kind of days
    assert joined and max(joined) < n_rows * n_feeds / 5


def test_feeds_of_one_name_and_wide_bounds(spark):
    """Rows of a name are ranked together before each condition's own bound; sizes may be any long."""
    low, high = -(1 << 63), (1 << 63) - 1
    given = [("f", None, None, low, high, None, None, 1), ("f", "en", None, -1, 9, None, None, 3), ("g", None, None, low, low + 1, None, None, 2), ("g", None, None, 5, 5, None, None, 9), ("h", None, None, high - 1, high, DAY, DAY, 2)]
    rows = [(k, "en", None, size, DAY, None) for k, size in enumerate([low, -1, 0, 8, 9, high - 1, high])]
    route = lambda m: feeds.route_table(spark.createDataFrame(rows, ROW), spark.createDataFrame(given, FEED), *[F.col(c) for c in ("lang", "tags", "size", "day")], ["id"], m)
    for m in (0, 1 << 20):
        found = sorted((r["feed"], r["rank"], r["id"]) for r in route(m).collect())
        assert [x for x in found if x[0] != "f"] == [("g", 1, 0)]
        # ids 0, 1, 1, 2, 2, ...: the first condition gives rank 1 alone, the second one rank 2 or 3
        assert found[0] == ("f", 1, 0) and found[1][:1] + found[1][2:] == ("f", 1)
    bounds = [(0, 1), (-5, 45), (3, 4), (7, 9), (low, high), (low, low + 1), (-1, 1), (high - 1, high), (low, 3), (5, 5), (6, 2)]
    pairs = spark.createDataFrame(bounds, "low long, high long")
    for r in pairs.select("low", "high", feeds._blocks(F.col("low"), F.col("high")).alias("blocks")).collect():
        ends = sorted((b["block"] << b["level"], (b["block"] + 1) << b["level"]) for b in r["blocks"])
        assert [a for a, _ in ends[1:]] == [b for _, b in ends[:-1]]
        assert (ends[0][0], ends[-1][1]) == (r["low"], r["high"]) if r["low"] < r["high"] else not ends


def test_unopened_style_and_cut_tail(spark):
    pages = ["a</style><p>b", "<style>x</style>a</script>b", "a<style>p {}", "", None]
    rows = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    found = {r["i"]: r["t"] for r in rows.select("i", html_to_text(F.col("html")).alias("t")).collect()}
    assert found == {0: "a b", 1: "a b", 2: "a p {}", 3: "", 4: None}
