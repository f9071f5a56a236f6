"""Near duplicates: documents whose sets of word n-grams have at least a given Jaccard similarity.

The search is a T-occurrence search after DivideSkip, in two rounds.

First, who can have a partner at all. A set of n needs T = ceil(least n) shared n-grams with any partner. With the n-grams
in the order of their hash, let a prefix hold the n - T + 1 + e smallest, e a share of n. Of two linked sets take the one
whose prefix ends first: at most n - T of its prefix are not shared, so at least 1 + e are, and all of those lie in both
prefixes. A set that has fewer than 1 + e(T) of its prefix in common with all others together is left out.

Second, groups of near copies, in which every list is long. Each set has a leader, the first set of most of its lists,
and is written as the difference from it: with c the leader, r what a set lacks of c and D all its differences,
|a & b| = |c| - r_a - r_b + |D_a & D_b|. Sets of one leader so need T_ab = needed overlap - |c| + r_a + r_b shared
differences. Where that is none or less they are linked outright, and a star around the set closest to the leader says
it all. Differences that the same sets have come in bundles, as one change of a text makes several; sets that need no
more than a bundle's differences are linked to the one of the bundle that is closest to the leader, and a bundle has one
list. What is left apart is searched: the lists of differences, rarest first, are divided: the T - 1 longest are skipped, the others are merged, and
each candidate is probed by binary search in the skipped ones. Sets of different leaders are searched through the lists of
their prefixes likewise: of each set the longest are skipped, and candidates are probed in their whole sets.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobsluice.llm.arrays import Words, mixed, ngrams, pieces, stretches, words
from jobsluice.llm.common import join_counted, read, stored, text_of

#: Share of a set, in hundredths, by which its prefix is longer than links need: over all sets, and over those left.
EXTRA, EXTRA_LEFT = 8, 30
#: Sets of a leader from which on its group takes in others.
LARGE = 8
#: Rows whose sets a worker unpacks at once.
ROWS = 512
#: Lists of more sets are merged by a join instead of a heap.
LONG = 64
#: Ids of sets in question are broadcast up to this many; beyond it they are joined by a shuffle.
BROADCAST_ROWS = 4_000_000


def _sets(found: Words, size: int) -> Iterator[np.ndarray]:
    """Of each text its n-grams' hashes, sorted, each once; of a text with fewer words than n the whole as one."""
    grams = ngrams(found.hashes, size)
    for first, stop in zip(found.firsts[:-1], found.firsts[1:]):
        if stop - first >= size:
            yield np.unique(grams[first : stop - size + 1])
        else:
            yield ngrams(found.hashes[first:stop], stop - first) if stop > first else np.zeros(0, np.uint64)


class Rule(NamedTuple):
    """When sets are linked: words of an n-gram, and the least similarity in hundredths (50 to 100)."""

    size: int = 5
    least: int = 80

    def prefix_length(self, n: int, extra: int) -> int:
        return min(n, n + (-self.least * n // 100) + 1 + extra * n // 100) if n else 0

    def needed(self, n: Column, extra: int) -> Column:
        """Occurrences that a set of n needs in the lists of its prefix."""
        least = F.ceil(self.least * n / 100)
        return F.least(least, 1 + F.floor(extra * least / 100))

    def compatible(self, a: Column, b: Column) -> Column:
        """Whether sets of these sizes can be linked at all."""
        return 100 * F.least(a, b) >= self.least * F.greatest(a, b)


def _sizes(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(s) for _, _, data, offsets in stretches(batch.column(1)) for s in _sets(words(data, offsets, lower=True), size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["id", "n"])

    return run


def _prefixes(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, data, offsets in stretches(batch.column(1)):
                sets = list(_sets(words(data, offsets, lower=True), rule.size))
                k = np.array([rule.prefix_length(len(s), EXTRA) for s in sets])
                grams = np.concatenate([s[:j] for s, j in zip(sets, k)])
                rows = np.repeat(np.arange(stop - first), k)
                n = np.array([len(s) for s in sets], np.int32)[rows]
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), batch.column(0).slice(first, stop - first).take(pa.array(rows)), pa.array(n)], ["gram", "id", "n"])

    return run


def _whole(size: int):
    """id, n, two independent sums that tell sets apart, and the sorted hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, ROWS):
            sets = [s for _, _, data, offsets in stretches(batch.column(1)) for s in _sets(words(data, offsets, lower=True), size)]
            one = np.array([mixed(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            two = np.array([mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            columns = [batch.column(0), pa.array([len(s) for s in sets], pa.int32()), pa.array(one), pa.array(two), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "key1", "key2", "grams"])

    return run


def _shared(x: bytes, y: bytes) -> tuple[int, int, int]:
    """Sizes of two sorted sets and of what they share, by binary search of the smaller in the larger."""
    a, b = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
    if not len(a):
        return len(a), len(b), 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return len(a), len(b), int((b[at] == a).sum())


def _linked(rule: Rule):
    """Of pairs with both sets (a, b, grams_a, grams_b) the linked ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, ROWS):
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                a, b, both = _shared(x, y)
                keep.append(100 * both >= rule.least * (a + b - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs with their differences (a, b, t, diff_a, diff_b) those that share t of them."""
    for batch in pieces(batches, ROWS):
        keep = [_shared(x, y)[2] >= t for t, x, y in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)))]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough. A hot partner's pairs are split by Spark."""
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("grams_a")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("grams").alias("grams_b")), "b")
    return both.select("a", "b", "grams_a", "grams_b").mapInArrow(_linked(rule), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """id, component of all ids in ``links`` (a, b): the smallest id reachable, by repeated minima and short cuts."""
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("component")).withColumnRenamed("a", "id"), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("near"))
        new = labels.join(near, labels["id"] == near["a"]).select("id", "component", F.least("component", "near").alias("least"))
        jump = labels.select(F.col("id").alias("least"), F.col("component").alias("far"))
        new = stored(new.join(jump, "least").select("id", F.least("least", "far").alias("component"), (F.least("least", "far") < F.col("component")).alias("moved")), "labels")
        labels = new.select("id", "component")
        if new.filter("moved").limit(1).count() == 0:
            return labels


def _with_component(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))


def leaders(lists: DataFrame) -> DataFrame:
    """id, leader: the smallest id in most of a set's lists, and so on from leader to leader up to one that is its own."""
    first = lists.groupBy("gram").agg(F.min("id").alias("lead"))
    met = lists.join(first, "gram").groupBy("id", "lead").agg(F.count(F.lit(1)).alias("k"))
    named = stored(met.groupBy("id").agg(F.max_by("lead", F.struct("k", -F.col("lead"))).alias("leader")), "leaders")
    while True:
        far = named.select(F.col("id").alias("leader"), F.col("leader").alias("far"))
        new = stored(named.join(far, "leader").select("id", F.col("far").alias("leader"), (F.col("far") < F.col("leader")).alias("moved")), "leaders")
        named = new.select("id", "leader")
        if new.filter("moved").limit(1).count() == 0:
            return named


def joined_leaders(lists: DataFrame, named: DataFrame, rule: Rule) -> DataFrame:
    """The same with small groups joined to large ones: of the groups that have members in enough of a set's lists for a
    link, the set goes to the largest. Groups of fewer than LARGE sets take in nobody."""
    sizes = named.groupBy("leader").agg(F.count(F.lit(1)).alias("members"))
    large = named.join(sizes.filter(F.col("members") >= LARGE), "leader")
    of_list = lists.join(large, "id").groupBy("gram", "leader").agg(F.first("members").alias("members"))
    votes = lists.join(of_list, "gram").groupBy("id", "leader").agg(F.count(F.lit(1)).alias("k"), F.first("members").alias("members"), F.first("n").alias("n"))
    best = votes.filter(F.col("k") >= rule.needed(F.col("n"), EXTRA_LEFT)).groupBy("id").agg(F.max_by("leader", F.struct("members", "k", "leader")).alias("best"))
    return stored(named.join(best, "id", "left").select("id", F.coalesce("best", "leader").alias("leader")), "leaders")


def _differences(rule: Rule):
    """Sets as differences from their leaders: what a set lacks of its leader is told from what it adds by a mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.uint64(0xA5A5A5A5A5A5A5A5)
        for batch in pieces(batches, ROWS):
            n_leader, g, sizes, diffs = [], [], [], []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                own, lead = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                lacks = mixed(np.setdiff1d(lead, own, assume_unique=True) ^ mask)
                diff = np.sort(np.concatenate([lacks, mixed(np.setdiff1d(own, lead, assume_unique=True))]))
                n_leader.append(len(lead))
                g.append(rule.least * len(own) + (100 + rule.least) * len(lacks))
                sizes.append(len(diff))
                diffs.append(diff.tobytes())
            numbers = [pa.array(v, pa.int64()) for v in (n_leader, g, sizes)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *numbers, pa.array(diffs, pa.binary())], ["id", "leader", "n_leader", "g", "size", "diff"])

    return run


def _explode_differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, ROWS):
        rows = pa.array(np.repeat(np.arange(batch.num_rows), np.array(batch.column(1).to_pylist(), np.int64)))
        flat = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), pa.array(flat)], ["id", "part"])


def _merge(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by query; each is one of its short lists, at most LONG members in the order of their ids. A heap merges a
    query's lists; a partner is a candidate where its place in a list leaves room for the shared differences it needs."""
    pending: list[tuple] = []

    def search(query: list[tuple]) -> list[tuple[int, int, int]]:
        a, component, g, size, whole, scale = query[0][:6]
        lists = [[(p["id"], p["component"], p["g"], p["size"], p["place"], place) for p in members] for *_, place, members in query]
        out = []
        for b, same in groupby(heapq.merge(*lists), key=lambda m: m[0]):
            for _, c, g_b, size_b, place_b, place in same:
                t = -((whole - g - g_b) // scale)
                if b < a and c != component and t >= 1 and place <= size - t and place_b <= size_b - t:
                    out.append((a, b, t))
                    break
        return out

    for pdf in rows:
        done = []
        for row in pdf.itertuples(index=False, name=None):
            if pending and pending[0][0] != row[0]:
                done += search(pending)
                pending = []
            pending.append(row)
        yield pd.DataFrame(done, columns=["a", "b", "t"], dtype="int64")
    if pending:
        yield pd.DataFrame(search(pending), columns=["a", "b", "t"], dtype="int64")


def _bundles(parts: DataFrame) -> DataFrame:
    """leader, part, df, m: of the differences that more than one set has, one set of them not linked outright, those with
    the same sets are a bundle of m. It is told by the smallest, and df sets have it."""
    sets = [F.bit_xor(F.xxhash64("id", F.lit(k))).alias(f"sets{k}") for k in (0, 1)]
    often = parts.groupBy("leader", "part").agg(F.count(F.lit(1)).alias("df"), F.bool_and("outright").alias("done"), *sets).filter("df > 1 and not done")
    return often.groupBy("leader", "df", "sets0", "sets1").agg(F.min("part").alias("part"), F.count(F.lit(1)).alias("m")).select("leader", "part", "df", "m")


def _links_by_difference(diffs: DataFrame, star: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) among the sets of one leader that share the differences they need, beyond those of ``star``."""
    scale = 100 + rule.least
    # The fewest differences that a set shares with any partner; sets that have fewer are left out.
    t_own = F.greatest(F.lit(1), F.ceil((F.col("g") + F.col("least_g") - scale * F.col("n_leader")) / scale))
    own = diffs.filter("size > 0").withColumn("t_own", t_own).filter("size >= t_own").select("id", "leader", "n_leader", "g", "size", "diff", "outright", "t_own")
    own = stored(own, "own")
    parts = own.select("id", "size", "diff").mapInArrow(_explode_differences, "id long, part long")
    parts = stored(parts.join(own.select("id", "leader", "outright"), "id"), "parts")
    members = parts.select("id", "leader", "part").join(_bundles(parts), ["leader", "part"])
    members = stored(members.join(own.select("id", "g", "n_leader", "size", "t_own"), "id"), "members")
    centre = members.groupBy("leader", "part").agg(F.min(F.struct("g", "id")).alias("centre"))
    enough = F.col("g") + F.col("centre.g") <= scale * (F.col("n_leader") + F.col("m"))
    same = members.join(centre, ["leader", "part"]).filter((F.col("id") != F.col("centre.id")) & enough)
    same = stored(same.select(F.col("id").alias("a"), F.col("centre.id").alias("b")).distinct(), "same")
    labels = components(star.union(same))
    # In the order of rarity, bundle by bundle; what has no bundle here comes first: no pair still apart shares it. A set has
    # a bundle whole or not at all, so that the list of its first difference has whatever the others' have.
    per = Window.partitionBy("id")
    before = F.sum("m").over(per.orderBy("df", "part").rowsBetween(Window.unboundedPreceding, -1))
    placed = members.withColumn("place", F.col("size") - F.sum("m").over(per) + F.coalesce(before, F.lit(0)))
    short = _with_component(placed.filter(F.col("place") <= F.col("size") - F.col("t_own")), labels)
    kinds = short.groupBy("leader", "part").agg(F.count(F.lit(1)).alias("length"), F.min("component").alias("c1"), F.max("component").alias("c2")).filter("c1 < c2")
    whole = scale * F.col("n_leader")
    lists = stored(short.join(kinds.select("leader", "part", "length"), ["leader", "part"]).withColumn("whole", whole), "lists")
    member = F.struct("id", "component", "g", "size", "place")
    members = lists.filter(F.col("length") <= LONG).groupBy("leader", "part").agg(F.sort_array(F.collect_list(member)).alias("members"))
    queries = lists.filter(F.col("length") <= LONG).join(members, ["leader", "part"]).select("id", "component", "g", "size", "whole", F.lit(scale).alias("scale"), "place", "members")
    merged = queries.repartition("id").sortWithinPartitions("id").mapInPandas(_merge, "a long, b long, t long")
    long = lists.filter(F.col("length") > LONG)
    other = long.select("leader", "part", *[F.col(c).alias(f"{c}_b") for c in ("id", "component", "g", "size", "place")])
    t = F.ceil((F.col("g") + F.col("g_b") - F.col("whole")) / scale)
    room = (t >= 1) & (F.col("place") <= F.col("size") - t) & (F.col("place_b") <= F.col("size_b") - t)
    met = long.join(other, ["leader", "part"]).filter((F.col("id_b") < F.col("id")) & (F.col("component") != F.col("component_b")) & room)
    pairs = merged.union(met.select(F.col("id"), F.col("id_b"), t)).dropDuplicates(["a", "b"])
    with_a = pairs.join(own.select(F.col("id").alias("a"), F.col("diff").alias("diff_a")), "a")
    both = with_a.join(own.select(F.col("id").alias("b"), F.col("diff").alias("diff_b")), "b")
    return same.union(both.select("a", "b", "t", "diff_a", "diff_b").mapInArrow(_probed, "a long, b long"))


def _pairs_over_leaders(lists: DataFrame, named: DataFrame, labels: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) of different leaders and components that may occur together in enough lists.

    A set that needs T occurrences with any partner skips its T - 1 longest lists: a partner stands in one of the others.
    """
    rows = _with_component(lists, labels).join(named, "id")
    open_ = stored(_mixed(rows), "open")
    enough = open_.groupBy("id").agg(F.count(F.lit(1)).alias("k"), F.max("n").alias("n")).filter(F.col("k") >= rule.needed(F.col("n"), EXTRA_LEFT)).select("id")
    open_ = stored(open_.join(enough, "id", "left_semi"), "open")
    lengths = open_.groupBy("gram").agg(F.count(F.lit(1)).alias("length"))
    per = Window.partitionBy("id")
    # The order of length and hash is one for all sets, so that of what two of them share each has the first among its shortest.
    place = F.row_number().over(per.orderBy("length", "gram"))
    placed = open_.join(lengths, "gram").withColumn("place", place).withColumn("k", F.count(F.lit(1)).over(per))
    smallest = F.ceil(rule.least * F.col("n") / 100)
    short = stored(_mixed(placed.filter(F.col("place") <= F.col("k") - rule.needed(smallest, EXTRA_LEFT) + 1)), "short")
    other = short.select("gram", *[F.col(c).alias(f"{c}_b") for c in ("id", "n", "component", "leader", "place", "k")])
    differ = (F.col("id_b") < F.col("id")) & (F.col("component") != F.col("component_b")) & (F.col("leader") != F.col("leader_b"))
    t = rule.needed(F.least("n", "n_b"), EXTRA_LEFT)
    room = (F.col("place") <= F.col("k") - t + 1) & (F.col("place_b") <= F.col("k_b") - t + 1)
    met = short.join(other, "gram").filter(differ & rule.compatible(F.col("n"), F.col("n_b")) & room)
    return met.select(F.col("id").alias("a"), F.col("id_b").alias("b")).distinct()


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows in lists that hold sets of different leaders and of different components."""
    kinds = rows.groupBy("gram").agg(F.min("leader").alias("l1"), F.max("leader").alias("l2"), F.min("component").alias("c1"), F.max("component").alias("c2"))
    return rows.join(kinds.filter("l1 < l2 and c1 < c2").select("gram"), "gram")


def links_of(sets: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) between distinct sets (id, n, grams), enough of them to join whatever links join."""
    lists = sets.mapInArrow(_explode_prefixes(rule), "gram long, id long, n int")
    lists = stored(_likely(lists, rule, EXTRA_LEFT), "lists")
    named = joined_leaders(lists, leaders(lists), rule)
    grams = sets.select("id", "grams")
    with_leader = grams.join(named, "id").join(grams.select(F.col("id").alias("leader"), F.col("grams").alias("of_leader")), "leader")
    diffs = with_leader.select("id", "leader", "grams", "of_leader").mapInArrow(_differences(rule), "id long, leader long, n_leader long, g long, size long, diff binary")
    diffs = stored(diffs, "differences")
    least_g = F.min(F.when(F.col("size") > 0, F.col("g"))).alias("least_g")
    groups = stored(diffs.groupBy("leader").agg(F.min(F.struct("g", "id")).alias("centre"), least_g, F.count(F.lit(1)).alias("members")), "groups")
    diffs = join_counted(diffs, groups, ["leader"], "members", diffs.count(), ["id"])
    # Sets of one leader that are linked outright with its centre are one component: of two of them no more is asked.
    diffs = diffs.withColumn("outright", F.col("g") + F.col("centre.g") <= (100 + rule.least) * F.col("n_leader"))
    star = stored(diffs.filter("outright and id != centre.id").select(F.col("id").alias("a"), F.col("centre.id").alias("b")), "star")
    close = stored(_links_by_difference(diffs, star, rule), "close")
    labels = components(star.union(close))
    over = verified(_pairs_over_leaders(lists, named, labels, rule), sets, rule)
    return stored(star.union(close).union(over), "links")


def _likely(postings: DataFrame, rule: Rule, extra: int) -> DataFrame:
    """The postings in lists of more than one set, of the sets that have enough of them for any link."""
    shared = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("length")).filter("length > 1")
    rows = stored(postings.join(shared, "gram").select("gram", "id", "n"), "shared")
    counted = rows.groupBy("id").agg(F.count(F.lit(1)).alias("k"), F.max("n").alias("n"))
    return rows.join(counted.filter(F.col("k") >= rule.needed(F.col("n"), extra)).select("id"), "id", "left_semi")


def near_duplicates(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id of each row of ``docs``: the set's size and the smallest id reachable by links.

    Words are split at ASCII white space with A-Z lower-cased; a set holds the hashes (64 bits) of the text's n-grams, of
    a shorter text the whole as one. Null and empty texts and such of white space alone have no words and no links.
    Rows that repeat an id belong together by it. Null ids are one id, shown as null, that comes first. An empty table
    gives no rows; other columns are not read.

    Equal sets are one class, represented by its smallest id, and only classes are compared.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-1 << 63))
    texts = docs.select(key.alias("id"), text_of(text_col).alias("text"))
    sizes = texts.mapInArrow(_sizes(rule.size), "id long, n long")
    postings = texts.mapInArrow(_prefixes(rule), "gram long, id long, n int")
    shared = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("length")).filter("length > 1")
    counted = postings.join(shared, "gram").groupBy("id").agg(F.count(F.lit(1)).alias("k"), F.max("n").alias("n"))
    likely = stored(counted.filter(F.col("k") >= rule.needed(F.col("n"), EXTRA)).select("id"), "likely")
    small = F.broadcast(likely) if likely.count() <= BROADCAST_ROWS else likely
    sets = stored(texts.join(small, "id", "left_semi").select("id", "text").mapInArrow(_whole(rule.size), "id long, n int, key1 long, key2 long, grams binary"), "sets")
    classes = stored(sets.groupBy("key1", "key2", "n").agg(F.min("id").alias("class"), F.count(F.lit(1)).alias("uses")), "keys")
    classes = stored(join_counted(sets.select("id", "key1", "key2", "n"), classes, ["key1", "key2", "n"], "uses", sets.count(), ["id"]).select("id", "class"), "classes")
    distinct = sets.join(classes.filter("id = class").select("id").distinct(), "id", "left_semi").dropDuplicates(["id"])
    distinct = stored(distinct.select("id", "n", "grams"), "distinct")
    labels = components(links_of(distinct, rule))
    named = classes.join(labels.withColumnRenamed("id", "class"), "class", "left").select(F.col("id"), F.coalesce("component", "class").alias("component"))
    named = named.groupBy("id").agg(F.min("component").alias("component"))
    rows = sizes.join(named, "id", "left").select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    return rows.select(*(F.when(F.col(c) != -1 << 63, F.col(c)).alias(c) if c != "n_shingles" else F.col(c) for c in rows.columns))


def _explode_prefixes(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, ROWS):
            sets = [np.frombuffer(x, np.uint64) for x in batch.column(2).to_pylist()]
            k = np.array([rule.prefix_length(len(s), EXTRA_LEFT) for s in sets], np.int64)
            rows = pa.array(np.repeat(np.arange(len(sets)), k))
            grams = np.concatenate([s[:j] for s, j in zip(sets, k)]) if sets else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows)], ["gram", "id", "n"])

    return run


def keep_one_of_each(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their group, with their columns; rows that repeat an id stay."""
    groups = near_duplicates(docs, rule, id_col, text_col)
    lost = groups.filter(~F.col("id").eqNullSafe(F.col("component_id"))).select(F.col("id").alias("lost id")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"))
    return rows.join(lost, F.col("id").eqNullSafe(F.col("lost id")), "left_anti").select("row.*")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(read(spark, sf_dir, "documents"), Rule(size=4, least=85))
    return rows.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
