"""Benchmark decontamination through a positional inverted index of the rarest benchmark words."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobsluice.llm.common import LOWER, UPPER, dropped, read, stored, text_of

#: Words of a window.
WINDOW = 13
#: Rarest words of each window whose postings are intersected.
RAREST = 3
#: Words by which a proximity match may be longer than its window.
SLOP = 8
#: Benchmark words and windows, and ids of contaminated documents, are broadcast up to this many rows and this many bytes,
#: both measured before; beyond either they are joined by shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20
#: One document in so many words hit is contaminated.
SHARE = 20
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words: stretches of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased."""
    return F.filter(F.split(F.translate(text, UPPER, LOWER), GAPS), lambda w: w != "")


def _tokens(text: Column) -> Column:
    """The same without a pass over the array: a leading gap leaves one empty first element, a trailing one a last."""
    return F.split(F.regexp_replace(F.translate(text, UPPER, LOWER), rf"^{GAPS}|{GAPS}\z", ""), GAPS)


def windows_of(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """window_id, items, words: the distinct windows of the benchmark; an item of fewer words than a window is one.

    Windows are told apart by their words and numbered. Numbers hold for one computation alone, so the table is stored.
    """
    items = benchmark.select(F.col(id_col).alias("item"), words_of(text_of(text_col)).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (window - 1)))
    rows = items.select("item", "w", F.explode(starts).alias("s")).select("item", F.slice("w", F.col("s"), F.lit(window)).alias("words"))
    rows = rows.groupBy("words").agg(F.collect_set("item").alias("items"))
    return stored(rows.withColumn("window_id", F.monotonically_increasing_id()), "windows")


def _is_small(df: DataFrame) -> bool:
    """Whether a stored table may be broadcast, by its rows and by their length spelt out."""
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))), F.lit(0))).first()
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def _small(df: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast where it is proven small."""
    return F.broadcast(df) if _is_small(df) else df


def anchors_of(docs: DataFrame, windows: DataFrame, text_col: str, rarest: int) -> DataFrame:
    """window_id, term, offset, k, n_anchors, words: of each window its words that are rarest in the documents, with places."""
    terms = windows.select("window_id", F.posexplode("words").alias("offset", "term"))
    distinct = stored(terms.select("term").distinct(), "terms")
    texts = docs.select(_tokens(text_of(text_col)).alias("w"))
    seen = texts.select(F.explode_outer("w").alias("term")).join(_small(distinct), "term").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    ranked = terms.join(_small(stored(seen, "seen")), "term")  # a window with a word that no document has cannot occur
    per = Window.partitionBy("window_id")
    order = per.orderBy("df", "term", "offset")
    ranked = ranked.withColumn("known", F.count(F.lit(1)).over(per)).withColumn("k", F.row_number().over(order)).filter(F.col("k") <= rarest)
    best = ranked.join(windows.select("window_id", "words"), "window_id").filter(F.col("known") == F.size("words"))
    return best.select("window_id", "term", "offset", "k", F.least(F.lit(rarest), F.size("words")).alias("n_anchors"), "words")


def postings(docs: DataFrame, anchors: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """id, term, pos, before, after: each place of an anchor word, with the words that a window around it can hold."""
    terms = stored(anchors.select("term").distinct(), "anchor-terms")
    rows = docs.select(F.col(id_col).alias("id"), _tokens(text_of(text_col)).alias("w"))
    rows = rows.select("id", "w", F.posexplode_outer("w").alias("pos", "term"))
    first = F.greatest(F.lit(0), F.col("pos") - (window - 1))
    cut = lambda df: df.select("id", "term", "pos", first.alias("first"), F.slice("w", first + 1, F.col("pos") - first + window).alias("near"))
    # Few terms meet the words where they are, and only what is found is cut. Many cross a shuffle, with cut surroundings.
    return cut(rows.join(F.broadcast(terms), "term")) if _is_small(terms) else cut(rows).join(terms, "term")


def find_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, rarest: int = RAREST, slop: int = SLOP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, items, start, length, kind: where windows of the benchmark occur in the documents.

    ``phrase``: the window's words stand at start, start + 1, ... ``near``: its rarest words all stand within the
    window's length plus ``slop`` words, in any order; each such stretch that holds no shorter one has a row, start is the first of the words, and stretches
    within a phrase's own place are left out.

    Postings of each window's ``rarest`` least frequent words are stored with their positions; lists are intersected
    after each position has its word's offset taken off; the words around a posting then confirm the phrase. Grouping
    is by document, window and start, so no frequent passage gathers in one group. Null and empty texts have no
    words; null ids are kept as ids; rows that repeat an id count as one document; empty tables give no rows.
    """
    return _found(*_index(docs, benchmark, window, rarest, id_col, text_col), window, rarest, slop)


def _index(docs: DataFrame, benchmark: DataFrame, window: int, rarest: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The stored tables of find_benchmark: windows, anchors and postings."""
    windows = windows_of(benchmark, window)
    anchors = stored(anchors_of(docs, windows, text_col, rarest), "anchors")
    return windows, anchors, stored(postings(docs, anchors, id_col, text_col, window), "postings")


def _intersected(hits: DataFrame, rarest: int) -> DataFrame:
    """id, window_id, start, length: where the lists of all of a window's anchors meet and the words around one confirm it.

    One shuffle: which anchors were met is told by a flag for each, not by a count of distinct places, which takes two.
    """
    agree = F.slice("near", F.col("start") - F.col("first") + 1, F.size("words")) == F.col("words")
    met = [F.bool_or(F.col("k") == k).alias(f"met{k}") for k in range(1, rarest + 1)]
    lists = hits.filter(F.col("start") >= F.col("first")).groupBy("id", "window_id", "start").agg(F.max(F.size("words")).alias("length"), F.bool_or(agree).alias("agree"), *met)
    all_met = [F.col(f"met{k}") | (F.col("length") < k) for k in range(1, rarest + 1)]
    return lists.filter(reduce(Column.__and__, all_met, F.col("agree"))).select("id", "window_id", "start", "length")


def _found(windows: DataFrame, anchors: DataFrame, index: DataFrame, window: int, rarest: int, slop: int) -> DataFrame:
    """The rows of find_benchmark from its stored tables."""
    hits = index.join(_small(anchors), "term").withColumn("start", F.col("pos") - F.col("offset"))
    phrases = _intersected(hits, rarest).withColumn("kind", F.lit("phrase"))
    # Proximity: the shortest stretch that ends at a posting starts at the earliest of the anchors' latest postings up to it.
    reach = window + slop
    upto = Window.partitionBy("id", "window_id").orderBy("pos").rangeBetween(Window.unboundedPreceding, 0)
    latest = F.array_compact(F.array(*[F.max(F.when(F.col("k") == k, F.col("pos"))).over(upto) for k in range(1, rarest + 1)]))
    ends = hits.filter(F.col("n_anchors") > 1).select("id", "window_id", "pos", "n_anchors", latest.alias("latest"))
    ends = ends.filter(F.size("latest") == F.col("n_anchors")).select("id", "window_id", F.array_min("latest").alias("start"), "pos")
    near = ends.groupBy("id", "window_id", "start").agg((F.min("pos") - F.col("start") + 1).alias("length")).filter(F.col("length") <= reach)
    # A stretch within a phrase's place is the phrase; of the phrases that start up to it, the last one reaches farthest.
    both = near.withColumn("end", F.lit(None).cast("long")).unionByName(phrases.select("id", "window_id", "start", "length", (F.col("start") + F.col("length")).cast("long").alias("end")))
    before = Window.partitionBy("id", "window_id").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    near = both.withColumn("reached", F.max("end").over(before)).filter(F.col("end").isNull() & (F.col("reached").isNull() | (F.col("start") + F.col("length") > F.col("reached"))))
    found = phrases.unionByName(near.select("id", "window_id", "start", "length", F.lit("near").alias("kind")))
    return found.join(windows.select("window_id", "items"), "window_id").select("id", "items", "start", "length", "kind")


def _hit(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, window: int = WINDOW, rarest: int = RAREST, slop: int = SLOP) -> DataFrame:
    """hit_id, n_hit, items: the documents with phrase matches, stored; the tables they were found by are deleted."""
    tables = _index(docs, benchmark, window, rarest, id_col, text_col)
    found = _found(*tables, window, rarest, slop).filter("kind = 'phrase'")
    spans = found.groupBy("id", "start").agg(F.max(F.col("start") + F.col("length")).alias("end"), F.flatten(F.collect_list("items")).alias("items"))
    before = Window.partitionBy("id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("reached", F.coalesce(F.max("end").over(before), F.lit(0)))
    new = F.greatest(F.lit(0), F.col("end") - F.greatest("start", "reached"))
    hit = spans.groupBy("id").agg(F.sum(new).alias("n_hit"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    hit = stored(hit.withColumnRenamed("id", "hit_id"), "hit")
    dropped(*tables)
    return hit


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """id, n_words, n_hit, items, contaminated for each row of ``docs``: a word inside any phrase match is hit.

    Matches of a document are merged in order of start, each adding what reaches beyond those before it. A document
    is contaminated with at least one word in twenty hit. ``items`` is null without matches. See find_benchmark.
    """
    hit = _hit(docs, benchmark, id_col, text_col, **options)
    rows = docs.select(F.col(id_col).alias("id"), F.size(words_of(text_of(text_col))).cast("long").alias("n_words"))
    rows = rows.join(hit, F.col("id").eqNullSafe(F.col("hit_id")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.select("id", "n_words", n_hit.alias("n_hit"), "items", ((n_hit > 0) & (SHARE * n_hit >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns; rows with a null id are judged together.

    Documents do not cross a shuffle for it where the ids of those that go are few enough for a broadcast, counted before.
    """
    bad = contamination(docs, benchmark, id_col, text_col, **options).filter("contaminated").select(F.col("id").alias("bad id")).distinct()
    bad = _small(stored(bad, "bad"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"))
    return rows.join(bad, F.col("id").eqNullSafe(F.col("bad id")), "left_anti").select("row.*")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    items = F.coalesce("items", F.array().cast("array<bigint>"))
    names = F.array_join(F.sort_array(F.transform(items, lambda i: i.cast("string"))), ",")
    return rows.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size(items).cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), "contaminated")


ORACLE = rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{GAPS}'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{GAPS}'), lambda x: x <> '') AS w FROM benchmark),
g AS (SELECT item_id, greatest(1, len(w) - {WINDOW - 1}) AS n, w, least(len(w), {WINDOW}) AS k FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS t FROM (SELECT *, unnest(range(1, n + 1)) AS s FROM g)),
sizes AS (SELECT DISTINCT k FROM win),
places AS (SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS t FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, sizes)),
m AS (SELECT doc_id, item_id, s, places.k FROM places JOIN win ON places.t = win.t AND places.k = win.k),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM m) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS names FROM m GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN items USING (doc_id)
"""
