"""Joins on time, sessions, rule tables, seen filters and the streams whose windows are tables, against plain loops."""

import bisect
import collections
import datetime
import random

import pytest
from pyspark.sql import functions as F

from jobsluice.operators import rule_index, seen_filter, tagging, timejoin
from jobsluice.sources.work import stored
from jobsluice.streaming.intake import new_rows
from jobsluice.streaming.windows import session_results, session_stream, sliding_results, sliding_windows

START = datetime.datetime(2024, 1, 1)
ROW = "id long, key string, ts timestamp, extra string"


def at(seconds):
    return START + datetime.timedelta(seconds=seconds)


def random_rows(seed, n, first=0):
    """Rows of which a third have one key, many share a time, and some lack key or time."""
    rng = random.Random(seed)
    return [(first + i, rng.choice(["hot", "hot", "a", "b", None]), None if rng.random() < 0.05 else at(rng.randrange(0, 4000)), None) for i in range(n)]


@pytest.mark.parametrize(("within", "slices"), [(300, 1), (300, 7), (0, 4), (100000, 16)])
def test_asof_is_the_latest_before(spark, within, slices):
    left, right = random_rows(1, 150), random_rows(2, 150, 1000)
    got = timejoin.asof_join(spark.createDataFrame(left, ROW), spark.createDataFrame(right, ROW), "key", "ts", within, "id", slices=slices)
    want = {}
    for i, k, t, _ in left:
        fits = [(rt, ri) for ri, rk, rt, _ in right if k is not None and t is not None and rk == k and rt is not None and 0 <= (t - rt).total_seconds() <= within]
        want[i] = max(fits)[1] if fits else None
    assert {r["id"]: r["match"]["id"] if r["match"] else None for r in got.collect()} == want
    assert got.count() == len(left)


@pytest.mark.parametrize(("before", "after", "slices"), [(60, 0, 1), (60, 200, 1), (60, 200, 5), (0, 0, 1)])
def test_pairs_of_an_interval(spark, before, after, slices):
    left, right = random_rows(3, 120), random_rows(4, 120, 1000)
    got = timejoin.interval_join(spark.createDataFrame(left, ROW), spark.createDataFrame(right, ROW), "key", "ts", before, after, slices)
    want = [(i, ri) for i, k, t, _ in left for ri, rk, rt, _ in right if k and k == rk and t and rt and -before <= (rt - t).total_seconds() <= after]
    assert sorted((r["left"]["id"], r["right"]["id"]) for r in got.collect()) == sorted(want)


def plain_sessions(rows, gap):
    out = collections.defaultdict(list)
    for key in {k for k, _ in rows}:
        times = sorted(t for k, t in rows if k == key)
        for t in times:
            if out[key] and (t - out[key][-1][1]).total_seconds() <= gap:
                out[key][-1][1:] = [t, out[key][-1][2] + 1]
            else:
                out[key].append([t, t, 1])
    return sorted(((k or "", *s) for k, v in out.items() for s in v), key=repr)


def in_time(rows):
    micros = lambda m: datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=m)
    return sorted(((r["key"] or "", micros(r["first"]), micros(r["last"]), r["n"]) for r in rows), key=repr)


@pytest.mark.parametrize("gap", [0, 7, 120])
def test_sessions_are_those_of_lag(spark, gap):
    rows = random_rows(5, 400)
    got = timejoin.sessions(spark.createDataFrame(rows, ROW), "key", "ts", gap).collect()
    assert in_time(got) == plain_sessions([(k, t) for _, k, t, _ in rows if t], gap)
    assert timejoin.sessions(spark.createDataFrame([], ROW), "key", "ts", gap).count() == 0


@pytest.mark.parametrize("order", [1, 2, 3])
def test_session_stream_whatever_the_batches(spark, tmp_path, order):
    """Rows out of order within the delay, in batches of any size; a batch that is run again changes nothing."""
    rng = random.Random(order)
    times = sorted(rng.randrange(0, 6000) for _ in range(150))
    rows = [(i, rng.choice(["hot", "a", None]), at(t), None) for i, t in enumerate(times)]
    shuffled = sorted(rows, key=lambda r: (r[2] + datetime.timedelta(seconds=rng.randrange(0, 500)), r[0]))
    cuts = sorted(rng.sample(range(1, 150), 3))
    run = lambda: session_stream(new_rows(spark, f"{tmp_path}/in", spark.createDataFrame([], ROW).schema), "key", "ts", 60, 1000, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    for a, b in zip([0, *cuts], [*cuts, 150]):
        spark.createDataFrame(shuffled[a:b], ROW).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        run()
    got = session_results(spark, f"{tmp_path}/out", "string").collect()
    assert in_time(got) == plain_sessions([(k, t) for _, k, t, _ in rows], 60)
    assert {r["closed"] for r in got} == {True, False}
    # The last batch failed after its tables were written: its commit is missing, and it is run anew.
    last = max(int(p.name) for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit())
    for name in (str(last), f".{last}.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink()
    run()
    assert in_time(session_results(spark, f"{tmp_path}/out", "string").collect()) == in_time(got)


def test_sliding_windows_and_late_rows_are_all(spark, tmp_path):
    batches = [[(1, "a", at(100), "1"), (2, None, at(50), "2")], [(3, "a", at(400), "3"), (4, "a", at(95), "4"), (5, "a", None, "5")], [(6, "a", at(99), "6"), (7, "a", at(390), None)]]
    for rows in batches:
        spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        sliding_windows(new_rows(spark, f"{tmp_path}/in", spark.createDataFrame([], ROW).schema), "key", "ts", "extra", 60, 20, 30, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    got = {(r["key"], (r["start"] - int(START.replace(tzinfo=datetime.UTC).timestamp()) * 1_000_000) // 1_000_000, r["late"]): (r["n"], r["total"]) for r in sliding_results(spark, f"{tmp_path}/out").collect()}
    want, marks = collections.Counter(), []
    for rows in batches:
        for _, k, t, _ in rows:
            if t:
                s = int((t - START).total_seconds())
                want.update((k, w, bool(marks) and w + 60 <= max(marks) - 30) for w in range(s // 20 * 20 - 40, s + 1, 20))
        marks += [int((t - START).total_seconds()) for _, _, t, _ in rows if t]
    assert {k: n for k, (n, _) in got.items()} == dict(want)
    assert any(late for _, _, late in got) and sum(n for n, _ in got.values()) == 6 * 3


@pytest.mark.parametrize(
    ("pattern", "words"),
    [
        ("cat", ["cat"]), ("cat|dog", ["cat", "dog"]), ("big cat", ["cat"]), ("licensed under [a-z]+|all rights", ["licensed", "rights"]), ("cats?", None), ("ca(t|r)", None), ("a b*", ["a"]),
        (r"node\.js", ["node"]), (r"node\d", None), ("[a-z]+ developer", ["developer"]), ("x[|]y|zz", None), ("(a|b) word", ["word"]), ("word{2}", None), ("pre.fix", None), ("", None), ("a|", None), ("(open", None), (r"c\+\+ dev", ["dev"]), (r"dev\n?x", None),
    ],
)
def test_needed_words(pattern, words):
    assert rule_index.needed_words(pattern) == words


def test_rule_index_gives_the_tags_of_the_unrolled_form(spark):
    rng = random.Random(6)
    vocabulary = [f"{a}{b}" for a in "kmprst" for b in ("ai", "ol", "un", "é")] + ["the", "node.js", "c++"]
    patterns = lambda: rng.choice(["{0}", "{0}|{1}", "{0} {1}", "{0} [a-z]+", "[a-z]+ {0}", "({0}|{1}) {2}", "{0}s?", r"{0}\.?{1}"]).format(*rng.sample([w for w in vocabulary if w.isascii() and w.isalpha()], 3))
    rules = [tagging.Rule(f"t{i % 25}", i, patterns(), patterns() if i % 3 == 0 else None, "^s[0-2]$" if i % 11 == 0 else None) for i in range(40)]
    rules.append(tagging.Rule("open", 99, "(kai|mol)[^a-z]"))
    texts = [(i, " ".join(rng.choice(vocabulary) + rng.choice(["", "", ".", "s", ","]) for _ in range(rng.randrange(0, 14))), rng.choice(["s1", "s7", None])) for i in range(300)] + [(900, None, "s1"), (901, "", None)]
    rows = spark.createDataFrame(texts, "id long, t string, s string")
    table = spark.createDataFrame([tuple(r) for r in rules], "tag string, priority int, include string, exclude string, second string")
    want = {r["id"]: r["x"] for r in rows.select("id", tagging.tags(rules, F.col("t"), F.col("s")).alias("x")).collect() if r["x"]}
    got = {r["id"]: r["tags"] for r in rule_index.tag_rows(rows, table, "id", "t", "s").collect()}
    # A null text has no words; only its second column can hit.
    assert got == want and len(want) > 100
    assert rule_index.tag_rows(rows.limit(0), table, "id", "t", "s").count() == 0 and rule_index.tag_rows(rows, table.limit(0), "id", "t").count() == 0


def test_patterns_without_words_are_few(spark, monkeypatch):
    monkeypatch.setattr(rule_index, "UNINDEXED", 1)
    table = spark.createDataFrame([("a", 1, "x+", None, None), ("b", 1, "y+", None, None)], "tag string, priority int, include string, exclude string, second string")
    with pytest.raises(ValueError, match="no word"):
        rule_index.tag_rows(spark.createDataFrame([(1, "x")], "id int, t string"), table, "id", "t")


@pytest.mark.parametrize("words", [1, 3, 400])
def test_seen_filter_is_exact(spark, words):
    rng = random.Random(words)
    rows = spark.createDataFrame([(rng.choice([None, *range(500)]), i) for i in range(300)], "k int, i int")
    seen = spark.createDataFrame([(rng.choice([None, *range(0, 900, 3)]),) for _ in range(400)], "k int")
    known = {r["k"] for r in seen.collect()}
    listed = stored(seen_filter.merged_filters(seen_filter.filter_of(seen.filter("k < 300"), ["k"], words), seen_filter.filter_of(seen.filter("k >= 300 or k is null"), ["k"], words)))
    assert listed.count() <= words
    got = seen_filter.drop_seen_by_filter(rows, seen, ["k"], listed, words)
    assert sorted(r["i"] for r in got.collect()) == sorted(r["i"] for r in rows.collect() if r["k"] not in known)


def test_seen_filter_lets_little_through(spark):
    seen, rows = spark.range(20000).select((F.col("id") * 2).alias("k")), spark.range(20000).select((F.col("id") * 2 + 1).alias("k"))
    words = seen_filter.words_for(20000)
    listed = stored(seen_filter.filter_of(seen, ["k"], words))
    assert seen_filter.perhaps(rows, ["k"], listed, words).filter("_perhaps").count() < 600
    assert seen_filter.perhaps(seen, ["k"], listed, words).filter("not _perhaps").count() == 0
    plan = seen_filter.drop_seen_by_filter(rows, seen, ["k"], listed, words)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 1 and "_perhaps" in plan or "bits" in plan


def test_bisect_agrees_on_hot_keys(spark):
    """One key with all rows: the latest before each is that of a sorted list."""
    times = sorted(random.Random(9).sample(range(100000), 2000))
    left = spark.createDataFrame([(i, "k", at(t + 0.5), None) for i, t in enumerate(range(0, 100000, 97))], ROW)
    right = spark.createDataFrame([(i, "k", at(t), None) for i, t in enumerate(times)], ROW)
    got = {r["id"]: r["match"]["id"] if r["match"] else None for r in timejoin.asof_join(left, right, "key", "ts", 10**6, "id").collect()}
    assert got == {i: (bisect.bisect_right(times, t + 0.5) - 1 if times[0] <= t + 0.5 else None) for i, t in enumerate(range(0, 100000, 97))}
