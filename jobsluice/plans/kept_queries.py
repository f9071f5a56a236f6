"""Queries of what is kept: histories, archives, sketches, marks of intake, figures of validation, parity without keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsluice.operators import checks, snapshots
from jobsluice.operators.history import HistoryTable, as_of, daily_sketches, history_of, merged_figures
from jobsluice.plans.posting_queries import CHECKS
from jobsluice.plans.registry import register
from jobsluice.sources.objects import dataset_pairs, write_dataset
from jobsluice.sources.tables import table
from jobsluice.sources.work import shared_dir, stored
from jobsluice.streaming.cursor import CursorIntake


def yearly(spark: SparkSession, sf_dir: str) -> list[tuple[int, DataFrame]]:
    """A snapshot of orders for each year from 1996 to 2000: those of the three years before it, some with another state."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    state = lambda y: F.when((F.col("o_orderkey") + y) % 10 == 0, "X").otherwise(F.col("o_orderstatus"))
    part = lambda y: orders.filter((F.col("o_orderdate") < f"{y}-01-01") & (F.col("o_orderdate") >= f"{y - 3}-01-01"))
    return [(y, part(y).select("o_orderkey", state(y).alias("s"))) for y in range(1996, 2001)]


YEARLY_SQL = """y AS (SELECT unnest(range(1996, 2001)) AS y), s AS (SELECT o_orderkey, y, CASE WHEN year(o_orderdate) BETWEEN y - 3 AND y - 1 THEN CASE WHEN (o_orderkey + y) % 10 = 0 THEN 'X' ELSE o_orderstatus END END AS s FROM orders, y)"""


@register("b19_history", f"""WITH {YEARLY_SQL}, l AS (SELECT *, lag(s) OVER (PARTITION BY o_orderkey ORDER BY y) AS p FROM s), c AS (SELECT * FROM l WHERE s IS DISTINCT FROM p),
    e AS (SELECT *, lead(y) OVER (PARTITION BY o_orderkey ORDER BY y) AS until FROM c) SELECT o_orderkey, s, y AS since, until FROM e WHERE s IS NOT NULL""")
def b19_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of three snapshots at once, into which two more are merged, the last one twice."""
    years = yearly(spark, sf_dir)
    kept = HistoryTable(spark, f"{shared_dir(spark, 'history')}/orders", "o_orderkey")
    kept.create(history_of(years[:3], "o_orderkey"))
    for at, rows in [*years[3:], years[-1]]:
        kept.merge(at, rows)
    return kept.read().select("o_orderkey", "value.s", "since", "until")


@register("b19_rebuilt", "SELECT y AS year, 0::BIGINT AS differing FROM (SELECT unnest(range(1996, 2001)) AS y)")
def b19_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows of each past snapshot differ from what the history gives for it: none."""
    years = yearly(spark, sf_dir)
    history = stored(history_of(years, "o_orderkey"), "history")
    parts = [snapshots.differences(rows, as_of(history, at), ["o_orderkey"]).agg(F.count(F.lit(1)).alias("differing")).select(F.lit(at).cast("long").alias("year"), "differing") for at, rows in years]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@register("b17_sketches", """SELECT year(o_orderdate)::INT AS year, o_orderpriority, count(*) AS n, count(DISTINCT o_custkey) AS n_orgs, true AS orgs_close, true AS median_close, true AS p90_close FROM orders GROUP BY ALL""")
def b17_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly figures merged from daily sketches, beside exact ones: estimates are within 6 in a hundred, ranks within 4 and one row."""
    rows = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderpriority", "o_custkey", "o_totalprice")
    daily = stored(daily_sketches(rows, F.col("o_orderdate").cast("date"), "o_orderpriority", "o_custkey", "o_totalprice"), "sketches")
    merged = merged_figures(daily, F.year("day"), "o_orderpriority", (0.5, 0.9)).withColumnsRenamed({"orgs": "_orgs", "n": "_n"})
    both = rows.withColumn("period", F.year("o_orderdate")).join(merged, ["period", "o_orderpriority"])
    close = lambda i, rank: F.abs(F.avg((F.col("o_totalprice") <= F.col(f"q{i}")).cast("int")) - rank) <= 0.04 + 1 / F.count(F.lit(1))
    exact = both.groupBy(F.col("period").alias("year"), "o_orderpriority").agg(F.max("_n").alias("n"), F.count_distinct("o_custkey").alias("n_orgs"), F.max("_orgs").alias("_orgs"), close(0, 0.5).alias("median_close"), close(1, 0.9).alias("p90_close"))
    return exact.select("year", "o_orderpriority", "n", "n_orgs", (F.abs(F.col("_orgs") - F.col("n_orgs")) <= 0.06 * F.col("n_orgs") + 1).alias("orgs_close"), "median_close", "p90_close")


@register("b30_archive_write", """SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, min(o_orderkey) AS first_key FROM orders WHERE o_orderdate >= '1997-03-01' AND o_orderdate < '1997-06-01' GROUP BY 1
    UNION ALL SELECT 'differences', 0, NULL""")
def b30_archive_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive written twice, by a cut-off that moves on; three months read from it, and live and archive against all."""
    orders = table(spark, sf_dir, "orders")
    path = f"{shared_dir(spark, 'archive')}/orders"
    for cutoff in ("1997-06-15", "1998-01-01"):
        live, old = snapshots.archive(orders, "o_orderdate", F.lit(cutoff).cast("timestamp_ntz"))
        snapshots.write_archive(old, path)
    kept = snapshots.archived(spark, path, old.schema)
    differing = snapshots.differences(orders, live.unionByName(kept.drop("month")), ["o_orderkey"]).agg(F.count(F.lit(1)).alias("n"))
    few = snapshots.archived(spark, path, old.schema, ["1997-03", "1997-04", "1997-05"]).groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"))
    return few.unionByName(differing.select(F.lit("differences").alias("month"), "n", F.lit(None).cast("long").alias("first_key")))


@register("b32_cursor", """SELECT event_type, CASE WHEN day(ts) <= 10 THEN 0 WHEN day(ts) <= 20 THEN 1 ELSE 2 END::BIGINT AS batch, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY ALL""")
def b32_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that come in three parts; the second run fails after its data and before its marks, and is run again."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    intake = CursorIntake(spark, f"{shared_dir(spark, 'intake')}/events", "event_type", "ts", "event_id")
    for upto, commit in ((10, True), (20, False), (20, True), (31, True)):
        intake.run(events.filter(F.dayofmonth("ts") <= upto), commit)
    return intake.data(events).groupBy("event_type", "batch").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@register("b5_in_passing", "SELECT 'rows' AS rule, count(*) AS n FROM documents" + "".join(f" UNION ALL SELECT '{name}', count(*) FILTER (NOT coalesce({sql}, false)) FROM documents" for name, (_, sql) in sorted(CHECKS.items())))
def b5_in_passing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents break each rule, counted while they are written."""
    path = f"{shared_dir(spark, 'validated')}/documents"
    counts = checks.validate_in_passing(table(spark, sf_dir, "documents"), {k: rule() for k, (rule, _) in CHECKS.items()}, path)
    return spark.createDataFrame(sorted(counts.items()), "rule string, n long")


@register("a15_without_keys", """SELECT 'customer' AS dataset, 'left_only' AS kind, count(*) AS n FROM customer WHERE c_custkey % 7 = 0 UNION ALL SELECT 'customer', 'right_only', count(*) FROM customer WHERE c_custkey % 7 = 0
    UNION ALL SELECT 'nation', 'right_only', count(*) FROM nation""")
def a15_without_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of datasets whose keys nobody has listed: one with other values in some rows, one with its rows twice, one equal."""
    work = shared_dir(spark, "pairs")
    t = lambda name: table(spark, sf_dir, name)
    for name in ("region", "nation", "customer"):
        write_dataset(t(name), f"{work}/left/{name}")
    write_dataset(t("region"), f"{work}/right/region")
    write_dataset(t("nation").union(t("nation")), f"{work}/right/nation")
    write_dataset(t("customer").withColumn("c_name", F.when(F.col("c_custkey") % 7 == 0, "other").otherwise(F.col("c_name"))), f"{work}/right/customer")
    return snapshots.parity_report(spark, dataset_pairs(spark, f"{work}/left", f"{work}/right"), {})
