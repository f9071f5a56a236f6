"""Substring deduplication: repeated k-word windows as edges of a De Bruijn graph, compacted to verified spans.

A window of k consecutive words is an edge from the k - 1 words it begins with to the k - 1 it ends with. Only edges
that occur more than once matter, and most occur once, so they are found in two steps. Each window has a seed, the stretch
of half as many words with the smallest hash in it; windows that are equal have equal seeds, and neighbouring windows
mostly share one. A run is a stretch of windows with one seed. Runs whose seed occurs once cannot hold a repeated edge and
go no further. The others meet at their seed, where each edge learns its source, the place where it occurs first.

What a document repeats in step with a source is a path of edges, and the distinct paths are the graph: their end nodes
have degrees, and where one path alone ends at a node and one alone begins there, the two are one. Such chains are
followed by joins, each of which doubles the distance, so that every path learns the chain it is part of. At last the
words along the chains are digested at their source coordinates, step by step. A document's repeats are read off the
chains: where it enters one, the chain tells how many words to take and their digest, and a span is cut only where the
document's own words have it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobsluice.llm.arrays import Words, mixed, ngrams, pieces, stretches, words
from jobsluice.llm.common import dropped, join_counted, read, stored, text_of, with_ids

K = 20
#: A seed with more runs than this meets edge by edge: of such, one task would otherwise hold all edges at once.
HOT = 1000
#: Rows that meet at one edge; where a seed has more runs, its edges' rows are dealt by id, and the firsts meet again.
MOST_MET = 4_000
NULL_ID = -1 << 63


def _runs(found: Words, k: int) -> tuple[np.ndarray, ...]:
    """Of the texts' runs: text, first window (word of the stretch), windows, seed; and the node at each word."""
    half = k // 2
    nodes, short = ngrams(found.hashes, k - 1), ngrams(found.hashes, half)
    none = np.zeros(0, np.int64)
    if len(nodes) < 2:
        return none, none, none, np.zeros(0, np.uint64), nodes
    text = np.repeat(np.arange(len(found.firsts) - 1), np.diff(found.firsts))
    starts = np.flatnonzero(text[: len(nodes) - 1] == text[k - 1 :])
    if not len(starts):
        return none, none, none, np.zeros(0, np.uint64), nodes
    views = np.lib.stride_tricks.sliding_window_view(short, k - half + 1)
    seed_at = np.empty(len(starts), np.int64)
    for first in range(0, len(starts), 1 << 15):
        part = starts[first : first + (1 << 15)]
        seed_at[first : first + len(part)] = part + views[part].argmin(axis=1)
    new = np.ones(len(starts), bool)
    new[1:] = (seed_at[1:] != seed_at[:-1]) | (text[starts[1:]] != text[starts[:-1]])
    heads = np.flatnonzero(new)
    return text[starts[heads]], starts[heads], np.diff(np.append(heads, len(starts))), short[seed_at[heads]], nodes


def _seeds(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, data, offsets in stretches(batch.column(1)):
                found = words(data, offsets)
                text, start, _, seed, _ = _runs(found, k)
                ids = batch.column(0).slice(first, stop - first).take(pa.array(text))
                yield pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), ids, pa.array((start - found.firsts[text]).astype(np.int32))], ["seed", "id", "start"])

    return run


MET = "meet long, id long, start int, deals int, nodes array<long>"
PIECES = "id long, start int, n int, tail long, head long, from_id long, from_start int, deals int"


def _edges(k: int):
    """Rows MET of the runs listed in ``starts``; ``nodes`` are those that the row's windows lead through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 256):
            listed = batch.column(2)
            for first, stop, data, offsets in stretches(batch.column(1)):
                found = words(data, offsets)
                text, start, n, seed, nodes = _runs(found, k)
                # A run is told by its text and first word; listed are (start, deals: 0 if it meets at its seed).
                lists = listed.slice(first, stop - first)
                counts = np.diff(np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1])
                flat = lists.flatten()
                wanted = found.firsts[np.repeat(np.arange(stop - first), counts)] + flat.field(0).to_numpy()
                order = np.argsort(wanted, kind="stable")
                at = np.minimum(np.searchsorted(wanted[order], start), len(order) - 1)
                hit = wanted[order][at] == start if len(order) else np.zeros(len(start), bool)
                deals = np.zeros(len(start), np.int64)
                deals[hit] = flat.field(1).to_numpy(zero_copy_only=False)[order][at[hit]]
                text, start, n, seed, deals = text[hit], start[hit], n[hit], seed[hit], deals[hit]
                own = batch.column(0).slice(first, stop - first)
                cool = deals == 0
                yield _rows(own, found, text[cool], start[cool], n[cool], seed[cool], deals[cool], nodes)
                # Runs of hot seeds: one row for each window, that meets at its node, dealt by id.
                if not cool.all():
                    which = np.repeat(np.flatnonzero(~cool), n[~cool])
                    ends = np.cumsum(n[~cool])
                    at_window = np.arange(len(which)) + np.repeat(start[~cool] - (ends - n[~cool]), n[~cool])
                    deal = mixed(own.to_numpy().view(np.uint64)[text[which]]) % deals[which].astype(np.uint64)
                    meet = mixed(nodes[at_window] + mixed(deal))
                    yield _rows(own, found, text[which], at_window, np.ones(len(which), np.int64), meet, deals[which], nodes)

    return run


def _rows(ids: pa.Array, found: Words, text: np.ndarray, start: np.ndarray, n: np.ndarray, meet: np.ndarray, deals: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
    ends = np.cumsum(n + 1)
    each = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - n - 1), n + 1)
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(nodes[each].view(np.int64)))
    columns = [pa.array(meet.view(np.int64)), ids.take(pa.array(text)), pa.array((start - found.firsts[text]).astype(np.int32)), pa.array(deals.astype(np.int32)), lists]
    return pa.RecordBatch.from_arrays(columns, ["meet", "id", "start", "deals", "nodes"])


def _sources(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of MET in the order of meeting, id and start: stretches of windows that occur earlier, with their sources.

    The first of those that were dealt comes out too, without a source: it may have one among those dealt elsewhere.
    Holds the first places of the windows of one meeting, at most HOT runs or one node's.
    """
    meet, first = None, {}
    for batch in batches:
        rows, last = [], None
        for here, doc, start, deals, nodes in zip(*(c.to_pylist() for c in batch.columns)):
            if here != meet:
                meet, first = here, {}
            last = None
            for place, edge in enumerate(zip(nodes, nodes[1:]), start):
                source = first.setdefault(edge, (doc, place))
                if source == (doc, place):
                    last = None
                    if deals > 1:
                        rows.append([doc, place, 1, *edge, None, None, deals])
                elif last is not None and source == (last[0], last[1] + 1):
                    rows[-1][2] += 1
                    rows[-1][4] = edge[1]
                    last = source
                else:
                    rows.append([doc, place, 1, *edge, *source, 0])
                    last = source
        columns = list(zip(*rows)) or [()] * 8
        types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["id", "start", "n", "tail", "head", "from_id", "from_start", "deals"])


def _met(rows: DataFrame) -> DataFrame:
    return rows.repartition("meet").sortWithinPartitions("meet", "id", "start").mapInArrow(_sources, PIECES)


def _repeats(texts: DataFrame, k: int) -> DataFrame:
    """Stretches (PIECES, all with a source) of the windows of ``texts`` (id, text) that occur earlier."""
    seeds = texts.mapInArrow(_seeds(k), "seed long, id long, start int")
    counts = stored(seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "seeds")
    total, most = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    deals = F.when(F.col("n") > HOT, F.ceil(F.col("n") / MOST_MET)).otherwise(0).cast("int")
    shared = join_counted(seeds, counts, ["seed"], "n", total, ["id", "start"])
    runs = stored(shared.groupBy("id").agg(F.collect_list(F.struct("start", deals.alias("deals"))).alias("runs")), "runs")
    some, _ = with_ids(texts, runs.select("id"))
    edges = some.join(runs, "id").select("id", "text", "runs").mapInArrow(_edges(k), MET)
    found = _met(edges)
    if most <= MOST_MET:
        return found.drop("deals")
    done = []
    while True:
        found = stored(found, "met")
        done.append(found.filter("from_start is not null").drop("deals"))
        left = found.filter("from_start is null")
        fewer = F.ceil(F.col("deals") / MOST_MET).cast("int")
        meet = F.xxhash64("tail", F.pmod(F.xxhash64("id", F.lit(len(done))), fewer))
        found = _met(left.select(meet.alias("meet"), "id", "start", fewer.alias("deals"), F.array("tail", "head").alias("nodes")))
        most = -(-most // MOST_MET)
        if most <= MOST_MET:
            return reduce(DataFrame.unionByName, [*done, found.filter("from_start is not null").drop("deals")])


def _in_step(parts: DataFrame) -> DataFrame:
    """A document's stretches joined where one follows another, and its source the other's source."""
    order = Window.partitionBy("id").orderBy("start")
    before = F.lag(F.struct((F.col("start") + F.col("n")).alias("start"), "from_id", (F.col("from_start") + F.col("n")).alias("from_start"))).over(order)
    parts = parts.withColumn("new", (~before.eqNullSafe(F.struct("start", "from_id", "from_start"))).cast("int"))
    parts = parts.withColumn("path", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    firsts = F.min(F.struct("start", "from_id", "from_start", "tail")).alias("f")
    rows = parts.groupBy("id", "path").agg(firsts, F.sum("n").cast("int").alias("n"), F.max_by("head", "start").alias("head"))
    return rows.select("id", "f.start", "n", "f.tail", "head", "f.from_id", "f.from_start")


def chains(paths: DataFrame) -> DataFrame:
    """``paths`` (distinct: tail, head, ...) with chain and step: which chain of the graph each is part of, and where.

    A node is passed through if one path ends there and one begins. From each such node the chain is followed back, twice
    as far with every join, up to a node that is not. A path between nodes that are not passed is a chain of its own, and
    so is each path of a ring, which has no beginning. No two paths share chain and step, but for collisions of 64 bits.
    """
    into = paths.groupBy(F.col("head").alias("node")).agg(F.count(F.lit(1)).alias("ins"), F.first("tail").alias("up"))
    out = paths.groupBy(F.col("tail").alias("node")).agg(F.count(F.lit(1)).alias("outs"))
    passed = stored(into.filter("ins = 1").join(out.filter("outs = 1"), "node").select("node", "up"), "nodes")
    alone = F.xxhash64(*paths.columns)
    nodes, reach = passed.count(), 1
    if not nodes:
        return paths.withColumns({"chain": alone, "step": F.lit(0)})
    known = passed.select(F.col("node").alias("up"), F.lit(True).alias("on"))
    walk = stored(passed.join(known, "up", "left").select("node", F.when(F.col("on"), F.col("up")).alias("up"), F.col("node").alias("top"), F.lit(0).alias("steps")), "walk")
    while reach <= nodes and walk.filter("up is not null").limit(1).count():
        far = walk.select(F.col("node").alias("up"), F.col("up").alias("far"), F.col("top").alias("far_top"), F.col("steps").alias("far_steps"))
        longer = walk.join(far, "up", "left").select("node", F.when(F.col("up").isNotNull(), F.col("far")).alias("up"), F.coalesce("far_top", "top").alias("top"), (F.col("steps") + F.when(F.col("up").isNotNull(), F.col("far_steps") + 1).otherwise(0)).alias("steps"))
        longer = stored(longer, "walk")
        dropped(walk)
        walk, reach = longer, 2 * reach
    walk = walk.filter("up is null")
    begins = walk.select(F.col("node").alias("tail"), F.col("top").alias("tail_top"), F.col("steps").alias("tail_steps"))
    ends = walk.filter("steps = 0").select(F.col("node").alias("head"), F.col("top").alias("head_top"))
    rows = paths.join(begins, "tail", "left").join(ends, "head", "left")
    return rows.select(*paths.columns, F.coalesce("tail_top", "head_top", alone).alias("chain"), F.coalesce(F.col("tail_steps") + 1, F.lit(0)).alias("step"))


def _word_digest(parts: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(parts), digest_size=16).digest()


def _digests(k: int):
    """Of texts (id, text, spans: start, n, chain, step) the digest of the words at each step of a chain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 64):
            rows = []
            for doc, text, spans in zip(*(batch.column(j).to_pylist() for j in range(3))):
                parts = text.encode().split()
                rows += [(s["chain"], s["step"], doc, s["start"], s["n"], _word_digest(parts[s["start"] : s["start"] + s["n"] + k - 1])) for s in spans]
            columns = list(zip(*rows)) or [()] * 6
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["chain", "step", "from_id", "from_start", "n", "digest"])

    return run


def _spans(texts: DataFrame, k: int) -> DataFrame:
    """repeated_spans of ``texts`` (id, text), with the digest of each one's source."""
    met = stored(_in_step(_repeats(texts, k)), "spans")
    key = ["from_id", "from_start", "n"]
    paths = met.groupBy(*key).agg(F.count(F.lit(1)).alias("uses"), F.first("tail").alias("tail"), F.first("head").alias("head"))
    graph = stored(chains(stored(paths, "paths")), "graph")
    # The words of each step of a chain, at its source.
    step = F.struct(F.col("from_start").alias("start"), "n", "chain", "step")
    asked = stored(graph.groupBy(F.col("from_id").alias("id")).agg(F.collect_list(step).alias("spans")), "asked")
    sources, _ = with_ids(texts, asked.select("id"))
    spelt = sources.join(asked, "id").select("id", "text", "spans").mapInArrow(_digests(k), "chain long, step int, from_id long, from_start int, n int, digest binary")
    # Rows that repeat an id with other texts have no one source; the least digest stands for them all.
    spelt = spelt.groupBy("chain", "step").agg(F.min(F.struct("from_id", "from_start", "n", "digest")).alias("at"))
    # Where a document enters a chain, it learns chain and step; what stands there is read off the chain.
    entered = graph.select(*[F.col(c).alias(f"met_{c}") for c in key], "uses", "chain", "step")
    known = stored(entered.join(spelt, ["chain", "step"]).select(*entered.columns, "at.*"), "known")
    total = known.agg(F.coalesce(F.sum("uses"), F.lit(0))).first()[0]
    rows = met.select("id", "start", *[F.col(c).alias(f"met_{c}") for c in key])
    rows = join_counted(rows, known, [f"met_{c}" for c in key], "uses", total, ["id", "start"])
    return rows.select("id", "start", (F.col("n") + (k - 1)).alias("n_words"), "from_id", "from_start", "chain", "step", "digest")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), text_of(text_col).alias("text"))


def repeated_spans(docs: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, start, n_words, from_id, from_start, chain, step: stretches of words whose k-word windows all occur earlier.

    Earlier is in a row with a smaller id, or in the same one at an earlier start; null ids come first. from_* is the
    source, an earlier place of the same words: where the windows occur first, but for those of very frequent seeds, which
    may have a later one. Stretches of one ``chain`` follow each other by ``step`` wherever the first of them occurs and
    goes on. An edge's identity is 128 bits, those of its two nodes.

    Texts of fewer than k words, null and empty ones have no windows. Rows that repeat id and text are one document; rows
    that only repeat the id share what is found in either. Empty tables give no rows; other columns are not read.
    """
    rows = _spans(_texts(docs, id_col, text_col), k)
    return rows.select(*(F.when(F.col(c) != NULL_ID, F.col(c)).alias(c) if c.endswith("id") else c for c in ("id", "start", "n_words", "from_id", "from_start", "chain", "step")))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        totals, removed, kept = [], [], []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            parts = text.encode().split()  # at the same six characters of ASCII white space
            keep = np.ones(len(parts), bool)
            for span in spans or ():
                first, stop = span["start"], span["start"] + span["n_words"]
                if _word_digest(parts[first:stop]) == span["digest"]:
                    keep[first:stop] = False
            totals.append(len(parts))
            removed.append(len(parts) - int(keep.sum()))
            kept.append(b" ".join([p for p, k in zip(parts, keep) if k] if removed[-1] else parts).decode())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["id", "n_words", "n_removed", "kept"])


def cut_repeats(docs: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_removed, kept for each row of ``docs``: the words outside of repeated_spans, joined by a space.

    A span is cut if its words have the digest of the words at its source. Null and empty texts have no words and keep
    the empty text; null ids are kept as such. Of rows that repeat id and text each is cut alike, where they repeat
    themselves; rows that share an id with another text are cut where their own words are those of a source. Empty tables
    give no rows; other columns are not read. Only texts with a span are shuffled.
    """
    texts, shape = _texts(docs, id_col, text_col), "id long, n_words long, n_removed long, kept string"
    spans = stored(_spans(texts, k).groupBy("id").agg(F.collect_list(F.struct("start", "n_words", "digest")).alias("spans")), "cuts")
    some, others = with_ids(texts, spans.select("id"))
    cut = some.join(spans, "id").select("id", "text", "spans").mapInArrow(_cut, shape)
    whole = others.select("id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans")).mapInArrow(_cut, shape)
    return cut.union(whole).withColumn("id", F.when(F.col("id") != NULL_ID, F.col("id")))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut_repeats(read(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
