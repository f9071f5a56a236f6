"""URL filters: explicit rules, and an empirical-Bayes reputation of hosts for the pages that no rule fits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsluice.llm.common import LOWER, UPPER, join_counted, read, stored

#: Rules of the registered query: host, start of the path, verdict.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
#: A host is blocked where the posterior's upper bound of its share of good pages is below this part of the overall share:
#: where it is credibly worse than the corpus, however good or bad that is.
LEAST_GOOD = 1.0
#: Standard deviations from the posterior mean to its bound.
Z = 1.645
#: Limits of a prior's strength, in pages.
WEAKEST, STRONGEST = 2.0, 1000.0


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://`` or where it is null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _strength(groups: DataFrame, level: str | None = None) -> float:
    """Pages that the prior above ``groups`` (n, k) counts for, by the method of moments over the shares in each level."""
    parts = groups.groupBy(*[level] * bool(level)).agg(F.sum("n").alias("gn"), F.sum("k").alias("gk"), F.sum(F.when(F.col("n") > 0, F.col("k") * F.col("k") / F.col("n")).otherwise(0.0)).alias("kk"), F.count_if(F.col("n") > 0).alias("m"))
    share = F.col("gk") / F.col("gn")
    noise = share * (1 - share)
    total = parts.filter("gn > 0").agg(F.sum(F.col("kk") - F.col("gk") * share).alias("spread"), F.sum(noise * F.col("m")).alias("sampling"), F.sum(noise * F.col("gn")).alias("noise")).first()
    between = (total["spread"] or 0.0) - (total["sampling"] or 0.0)
    return STRONGEST if between <= 0 else min(STRONGEST, max(WEAKEST, total["noise"] / between - 1))


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """host, n, k, mean, upper, least and the number of rows (seen) for each host of ``outcomes`` (host, good: 1, 0 or null for a page without a label).

    The share of good pages is shrunk from suffix (last label) over registered domain (last two labels) to host, each
    level a beta prior of the next, with strengths fitted to the spread of shares below. Counts are pre-aggregated, so
    a host with a third of all pages sends one row from each task. Without any label every mean is one half and no host is
    below ``least``. Null and empty hosts are hosts like others. The driver gets four numbers: the overall share and three
    strengths.
    """
    hosts = outcomes.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).cast("double").alias("k"), F.count(F.lit(1)).alias("seen"))
    labels = F.split("host", r"\.")
    hosts = stored(hosts.select("host", F.concat_ws(".", F.slice(F.concat(F.array(F.lit("")), labels), -2, 2)).alias("domain"), F.element_at(labels, -1).alias("suffix"), "n", "k", "seen"), "hosts")
    domains = stored(hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), "domains")
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("sn"), F.sum("k").alias("sk"))
    whole = suffixes.agg(F.coalesce(F.sum("sn"), F.lit(0)).alias("n"), F.coalesce(F.sum("sk"), F.lit(0.0)).alias("k")).first()
    root = (whole["k"] + 1) / (whole["n"] + 2)
    s0, s1, s2 = _strength(suffixes.select(F.col("sn").alias("n"), F.col("sk").alias("k"))), _strength(domains, "suffix"), _strength(hosts, "domain")
    domains = domains.select("domain", "suffix", F.col("n").alias("dn"), F.col("k").alias("dk"))
    rows = hosts.join(domains.join(suffixes, "suffix"), ["suffix", "domain"])
    rows = rows.withColumn("ms", (F.col("sk") + s0 * root) / (F.col("sn") + s0))
    rows = rows.withColumn("md", (F.col("dk") + s1 * F.col("ms")) / (F.col("dn") + s1))
    rows = rows.withColumn("a", F.col("k") + s2 * F.col("md")).withColumn("b", F.col("n") - F.col("k") + s2 * (1 - F.col("md")))
    mean = F.col("a") / (F.col("a") + F.col("b"))
    sd = F.sqrt(mean * (1 - mean) / (F.col("a") + F.col("b") + 1))
    return rows.select("host", "n", "k", mean.alias("mean"), (mean + Z * sd).alias("upper"), F.lit(LEAST_GOOD * root).alias("least"), "seen")


def _rules_of_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """host, rules: those that fit the host, longest first. The array grows with the rules, not with the pages."""
    labels = F.split("host", r"\.")
    ends = F.expr("transform(sequence(1, size(labels)), i -> array_join(slice(labels, i, size(labels)), '.'))")
    tails = hosts.select("host", labels.alias("labels")).select("host", F.explode(ends).alias("rule_host"))
    fit = F.sort_array(F.collect_list(F.struct((-F.length(F.concat("rule_host", "rule_path"))).alias("order"), F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict"), F.col("rule_path").alias("path"))))
    return tails.join(rules, "rule_host").groupBy("host").agg(fit.alias("rules"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: tuple[tuple[str, str, str], ...], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict, good_mean, good_upper, one row per row of ``pages``.

    ``outcomes`` has host and good (1, 0 or null). A rule fits its host and all subdomains where the path starts with
    the rule's path; the longest wins, of equal ones the first by name and then ``allow``. Pages without a rule are
    judged by their host's reputation, against the share of good pages overall. Null urls and such without ``://`` have an empty host and path. Repeated rows
    and null ids pass through; other columns are not read. An empty table gives no rows. Pages of a host that has
    many of them stay where they are and meet the host's row by a broadcast, so that no task has all pages of one host.
    """
    spark = pages.sparkSession
    listed = spark.createDataFrame(list(rules), "rule_host string, rule_path string, rule_verdict string")
    host, path = split_url(F.col("url"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.select("id", host.alias("host"), path.alias("path"))
    known = host_reputation(outcomes.select("host", "good").unionByName(rows.select("host", F.lit(None).cast("int").alias("good"))))
    of_host = known.join(_rules_of_hosts(known.select("host"), listed), "host", "left").withColumn("host_key", F.xxhash64("host"))
    of_host = stored(of_host.select("host_key", "host", "rules", "mean", "upper", "least", "seen"), "judged")
    total = of_host.agg(F.coalesce(F.sum("seen"), F.lit(0))).first()[0]
    rows = join_counted(rows.withColumn("host_key", F.xxhash64("host")), of_host, ["host_key", "host"], "seen", total, ["id", "path"])
    hit = F.get(F.filter("rules", lambda r: F.col("path").startswith(r["path"])), 0)
    judged = F.when(F.col("upper") < F.col("least"), "block").otherwise("allow")
    return rows.withColumn("hit", hit).select("id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce(F.col("hit.verdict"), judged).alias("verdict"), F.col("mean").alias("good_mean"), F.col("upper").alias("good_upper"))


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """host, good: a page is good where the document that its url numbers is labelled of quality and not toxic."""
    host, path = split_url(F.col("url"))
    ids = pages.select(F.col("url").cast("string").alias("url")).select(host.alias("host"), F.expr("try_cast(regexp_extract(url, '://[^/?#]*/[a-z]+/([0-9]+)', 1) as bigint)").alias("doc_id"))
    good = (F.min("quality") == 1) & (F.max("toxic") == 0)
    return ids.join(labels.groupBy("doc_id").agg(good.cast("int").alias("good")), "doc_id").select("host", "good")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    rows = filter_urls(pages, page_outcomes(pages, read(spark, sf_dir, "labels")), RULES)
    return rows.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def _oracle() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)

    def strength(groups: str, level: str, name: str) -> str:
        return f"""{name} AS (SELECT least({STRONGEST}, greatest({WEAKEST}, CASE WHEN coalesce(a - b, 0) <= 0 THEN {STRONGEST} ELSE c / (a - b) - 1 END)) AS {name} FROM (
            SELECT sum(kk - gk * gk / gn) AS a, sum(gk / gn * (1 - gk / gn) * m) AS b, sum(gk / gn * (1 - gk / gn) * gn) AS c FROM (
                SELECT sum(n) AS gn, sum(k) AS gk, sum(CASE WHEN n > 0 THEN k * k / n ELSE 0 END) AS kk, count(*) FILTER (n > 0) AS m FROM {groups} GROUP BY {level}) WHERE gn > 0))"""

    return rf"""
WITH cut AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, url, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
lab AS (SELECT doc_id, (min(quality) = 1 AND max(toxic) = 0)::INT AS good FROM labels GROUP BY doc_id),
outcome AS (SELECT host, good FROM p JOIN lab ON lab.doc_id = try_cast(regexp_extract(url, '://[^/?#]*/[a-z]+/([0-9]+)', 1) AS BIGINT) UNION ALL SELECT host, NULL FROM p),
h AS (SELECT host, count(good) AS n, coalesce(sum(good), 0)::DOUBLE AS k, regexp_extract(host, '([^.]*)$', 1) AS suffix, CASE WHEN contains(host, '.') THEN regexp_extract(host, '([^.]*\.[^.]*)$', 1) ELSE '.' || host END AS domain FROM outcome GROUP BY host),
d AS (SELECT suffix, domain, sum(n) AS n, sum(k) AS k FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d GROUP BY ALL),
root AS (SELECT (sum(k) + 1) / (sum(n) + 2) AS root FROM s),
{strength("s", "1 = 1", "s0")},
{strength("d", "suffix", "s1")},
{strength("h", "domain", "s2")},
m AS (SELECT h.host, h.n, h.k, s2, (d.k + s1 * ((s.k + s0 * root) / (s.n + s0))) / (d.n + s1) AS md FROM h JOIN d USING (suffix, domain) JOIN s USING (suffix), root, s0, s1, s2),
ab AS (SELECT host, k + s2 * md AS a, n - k + s2 * (1 - md) AS b FROM m),
bound AS (SELECT host, a / (a + b) + {Z} * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) AS upper FROM ab),
rules(rh, rp, rv) AS (VALUES {rules}),
hit AS (SELECT page_id, rh || rp AS rule, rv, row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC, rh || rp, rv) AS k FROM p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT p.page_id, p.host, p.path, hit.rule, coalesce(hit.rv, CASE WHEN upper < {LEAST_GOOD} * root THEN 'block' ELSE 'allow' END) AS verdict
FROM root, p JOIN bound USING (host) LEFT JOIN hit ON hit.page_id = p.page_id AND hit.k = 1
"""


ORACLE = _oracle()
