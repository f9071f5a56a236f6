"""Histories, archives, sketches, marks of intake, figures of validation and parity without keys."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from jobsluice.operators import checks, snapshots
from jobsluice.operators.history import HistoryTable, as_of, daily_sketches, history_of, merged_figures
from jobsluice.streaming.cursor import CursorIntake

SNAPSHOT = "k int, v string"


def random_snapshots(spark, seed, n):
    """Keys come, go, come back, change and are null; values may be null."""
    rng = random.Random(seed)
    out = []
    for at in range(1, n + 1):
        rows = [(k, rng.choice(["a", "b", None])) for k in [None, *range(12)] if rng.random() < 0.6]
        out.append((at * 10, spark.createDataFrame(rows, SNAPSHOT), dict(rows)))
    return out


def plain_history(parts):
    out = []
    for key in {k for _, _, rows in parts for k in rows}:
        held = None
        for at, _, rows in parts:
            now = (rows[key],) if key in rows else None
            if held and held[0] != now:
                out.append((key, held[0][0], held[1], at))
                held = None
            if now and not held:
                held = (now, at)
        if held:
            out.append((key, held[0][0], held[1], None))
    return sorted(out, key=repr)


def told(history):
    return sorted(((r["k"], r["value"]["v"], r["since"], r["until"]) for r in history.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_history_and_its_past(spark, tmp_path, seed):
    parts = random_snapshots(spark, seed, 5)
    history = history_of([(at, df) for at, df, _ in parts], "k")
    assert told(history) == plain_history(parts)
    for at, df, _ in parts:
        assert snapshots.differences(df, as_of(history, at + 3), ["k"]).count() == 0
    kept = HistoryTable(spark, f"file://{tmp_path}/h", "k")
    kept.create(history_of([(at, df) for at, df, _ in parts[:2]], "k"))
    for at, df, _ in [*parts[2:], parts[-1]]:
        kept.merge(at, df)
    assert told(kept.read()) == plain_history(parts)
    with pytest.raises(ValueError, match="goes up to"):
        kept.merge(15, parts[0][1])


def test_only_parts_with_changes_are_written(spark, tmp_path):
    rows = [(k, "a") for k in range(500)]
    kept = HistoryTable(spark, f"file://{tmp_path}/h", "k")
    kept.create(history_of([(1, spark.createDataFrame(rows, SNAPSHOT))], "k"))
    before = {p: p.stat().st_mtime_ns for p in Path(tmp_path, "h").rglob("*.parquet")}
    assert kept.merge(2, spark.createDataFrame([*rows[:-1], (499, "b")], SNAPSHOT)) == 1
    after = {p for p in Path(tmp_path, "h").rglob("*.parquet")}
    assert len(before.keys() - after) == 1 and len(before.keys() & after) == len(before) - 1
    assert kept.merge(3, spark.createDataFrame([*rows[:-1], (499, "b")], SNAPSHOT)) == 0
    assert kept.merge(4, spark.createDataFrame([], SNAPSHOT)) > 1 and as_of(kept.read(), 4).count() == 0 and as_of(kept.read(), 1).count() == 500


def test_archive_is_rerun_safe_and_pruned(spark, tmp_path):
    path = f"file://{tmp_path}/archive"
    rows = spark.createDataFrame([(i, f"2024-0{1 + i % 4}-15 00:00:00") for i in range(40)] + [(99, None)], "i int, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    for cutoff in ("2024-03-01", "2024-04-01", "2024-04-01"):
        live, old = snapshots.archive(rows, "t", F.lit(cutoff).cast("timestamp_ntz"))
        snapshots.write_archive(old, path)
    kept = snapshots.archived(spark, path, old.schema)
    assert snapshots.differences(rows, live.unionByName(kept.drop("month")), ["i"]).count() == 0
    few = snapshots.archived(spark, path, old.schema, ["2024-02"])
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert few.count() == 10 and "PartitionFilters: [isnotnull(month" in plan
    assert {p.name for p in Path(tmp_path, "archive").iterdir() if p.is_dir()} == {f"month=2024-0{m}" for m in (1, 2, 3)}


def test_sketches_merge_to_close_figures(spark):
    rows = spark.range(60000).select((F.col("id") % 30).cast("int").alias("day"), F.lit("g").alias("g"), (F.col("id") * 7919 % 20011).alias("org"), (F.col("id") % 1000).cast("double").alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(3, None, 1, None), (3, None, None, 2.0)], "day int, g string, org long, v double"))
    got = {r["g"]: r for r in merged_figures(daily_sketches(rows, F.col("day"), "g", "org", "v"), F.lit(0), "g", (0.1, 0.5, 0.99)).collect()}
    assert got["g"]["n"] == 60000 and abs(got["g"]["orgs"] - 20011) <= 0.06 * 20011
    assert all(abs(got["g"][f"q{i}"] / 1000 - r) < 0.04 for i, r in enumerate((0.1, 0.5, 0.99)))
    assert (got[None]["n"], got[None]["orgs"], got[None]["q1"]) == (2, 1, 2.0)


def test_intake_by_cursor(spark, tmp_path):
    schema = "s string, c int, i int"
    intake = CursorIntake(spark, f"file://{tmp_path}/t", "s", "c", "i")
    rows = [("a", 1, 1), ("a", 5, 2), (None, 3, 3), ("b", None, 4)]
    frame = lambda: spark.createDataFrame(rows, schema)
    assert intake.next_batch() == 0 and intake.run(frame(), commit=False) == 0
    assert intake.run(frame()) == 0 and intake.run(frame()) == 1
    rows += [("a", 5, 9), ("a", 4, 10), ("a", 6, 11), ("b", 1, 12), (None, 3, 13), (None, 2, 14)]
    assert intake.run(frame(), commit=False) == 2
    rows += [("b", 2, 15)]
    assert intake.run(frame()) == 2
    assert sorted((r["i"], r["batch"]) for r in intake.data(frame()).collect()) == [(1, 0), (2, 0), (3, 0), (9, 2), (11, 2), (12, 2), (13, 2), (15, 2)]


def test_counts_in_passing(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x"), (2, None), (None, "y")], "k int, v string")
    rules = {"has_k": F.col("k").isNotNull(), "long v": F.col("v") > "x"}
    assert checks.validate_in_passing(rows, rules, f"file://{tmp_path}/o") == {"rows": 3, "has_k": 1, "long v": 2}
    assert spark.read.parquet(f"file://{tmp_path}/o").filter("size(reasons) > 0").count() == 3
    assert checks.validate_in_passing(rows.limit(0), rules, f"file://{tmp_path}/o") == {"rows": 0, "has_k": 0, "long v": 0}


def test_whole_rows_are_compared(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "b"), (3, "c")], "k int, v string")
    right = spark.createDataFrame([(None, 1), ("b", 2), ("b", 2), ("d", 3)], "v string, k int")
    kinds = sorted(r["kind"] for r in snapshots.whole_row_differences(left, right).collect())
    assert kinds == ["left_only", "left_only", "right_only", "right_only"]
    assert snapshots.whole_row_differences(left, left).count() == 0
    assert snapshots.whole_row_differences(left, left.withColumn("more", F.lit(1))).count() == 8
