"""Tags from a table of thousands of rules, found through an inverted index of the words that their patterns need."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from jobsluice.functions.text import delimited
from jobsluice.sources.work import stored

#: Rows of the index that are broadcast, counted before; beyond it words are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Most patterns without a needed word: each is tried on every text.
UNINDEXED = 200
META = set("()[].*+?{}^$|\\")


def needed_words(pattern: str) -> list[str] | None:
    """For each alternative of a pattern a word that every text which it fits holds, the longest; None if one has none.

    A word is needed where plain letters and digits stand between plain separators or the alternative's ends, outside
    groups and classes, and no repetition follows. Anything else ends a run without making it a word, so that a word may be
    missed but never wrongly needed.
    """
    branches, depth, inside, at, start = [], 0, False, 0, 0
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            at += 1
        elif inside:
            inside = c != "]"
        elif c == "[":
            inside = True
            at += pattern[at + 1 : at + 2] == "]"
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "|" and depth == 0:
            branches.append(pattern[start:at])
            start = at + 1
        at += 1
    branches.append(pattern[start:])
    if depth or inside:
        return None
    found = [_needed(b) for b in branches]
    return sorted(set(found)) if all(found) else None


def _needed(branch: str) -> str | None:
    words, run, clean, depth, inside, at = [], "", True, 0, False, 0

    def close(boundary: bool) -> None:
        nonlocal run, clean
        if run and clean and boundary:
            words.append(run)
        run, clean = "", boundary

    while at < len(branch):
        c, after = branch[at], branch[at + 1 : at + 2]
        if c == "\\":
            at += 1
            plain = not depth and not inside and not after.isalnum() and branch[at + 1 : at + 2] not in ("?", "*", "+", "{")
            close(bool(plain))
        elif inside:
            inside = c != "]"
        elif c == "[":
            close(False)
            inside = True
        elif c in "()":
            close(False)
            depth += 1 if c == "(" else -1
        elif depth:
            pass
        elif c in META:
            close(False)
        elif after and after in "?*+{":
            close(False)
        elif c.isalnum():
            run += c
        else:
            close(True)
        at += 1
    close(True)
    return max(words, key=lambda w: (len(w), w)) if words else None


@F.pandas_udf(ArrayType(StringType()))
def _needed_words(patterns: pd.Series) -> pd.Series:
    return patterns.map(needed_words)


def index_of(rules: DataFrame) -> DataFrame:
    """rule, word, pattern: a line for each word that an include pattern needs, of rules with a number ``rule``.

    ``pattern`` is null where the word alone decides (patterns that are lists of plain words); ``word`` is null where a pattern
    needs none.
    """
    plain = F.col("include").rlike(r"^[a-z0-9]+(\|[a-z0-9]+)*$")
    words = F.when(plain, F.split("include", r"\|")).otherwise(_needed_words("include"))
    lines = rules.filter("include is not null").select("rule", F.when(~plain, F.col("include")).alias("pattern"), F.explode_outer(words).alias("word"))
    return lines.distinct()


def tag_rows(rows: DataFrame, rules: DataFrame, key: str, text: str, other: str | None = None) -> DataFrame:
    """key, tags: sorted tags of each row that has any, by the rules of a table with tagging.Rule's columns.

    ``text`` is lower-cased, ``key`` tells rows apart (rows that repeat it are one), and null texts have no words. The plan
    holds no rule: the text's words meet the index by an equi-join, and only patterns that more than their word decides are
    tried, on the texts that hold it; exclude patterns are tried where the rule hits. A tag that several rules give holds if
    any of them does. Patterns without a needed word are tried on every text; there may be UNINDEXED of them.
    """
    numbered = stored(rules.select(F.xxhash64("tag", "include", "exclude", "second").alias("rule"), "tag", "include", "exclude", "second").distinct(), "rules")
    lines = stored(index_of(numbered), "index")
    sizes = lines.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("word").isNull()).alias("open")).first()
    if sizes["open"] > UNINDEXED:
        raise ValueError(f"{sizes['open']} patterns need no word; there may be {UNINDEXED}")
    near = F.broadcast if sizes["n"] <= BROADCAST_ROWS else (lambda df: df)
    texts = rows.select(F.col(key).alias("key"), F.col(text).alias("text")).filter("text is not null")
    words = texts.select("key", F.explode(F.array_distinct(F.split("text", r"[^\p{L}\p{N}]+"))).alias("word"))
    found = stored(words.join(near(lines.filter("word is not null")), "word").select("key", "rule", "pattern"), "found")
    hits = found.filter("pattern is null").select("key", "rule")
    hits = hits.unionByName(_tried(texts, found.filter("pattern is not null")))
    if sizes["open"]:
        hits = hits.unionByName(texts.join(F.broadcast(lines.filter("word is null").select("rule", "pattern")), _fits(F.col("pattern"))).select("key", "rule"))
    if other is not None:
        values = rows.select(F.col(other).alias("value")).distinct()
        seconds = values.join(F.broadcast(numbered.filter("second is not null").select("rule", "second")), F.expr("value rlike second")).select("value", "rule")
        hits = hits.unionByName(rows.select(F.col(key).alias("key"), F.col(other).alias("value")).join(seconds, "value").select("key", "rule"))
    hits = stored(hits.distinct().join(near(numbered.select("rule", "tag", "exclude")), "rule"), "hits")
    guarded = _tried(texts, hits.filter("exclude is not null").select("key", "rule", F.col("exclude").alias("pattern")))
    held = hits.join(guarded, ["key", "rule"], "left_anti")
    return held.groupBy("key").agg(F.array_sort(F.collect_set("tag")).alias("tags")).withColumnRenamed("key", key)


def _tried(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """key, rule of the stored pairs (key, rule, pattern) whose pattern fits the text.

    One row for each text crosses the shuffle, and a pattern that several rules share is tried once on it.
    """
    tries = pairs.groupBy("key").agg(F.collect_set("pattern").alias("tries"))
    fits = texts.join(tries, "key").select("key", F.explode(F.filter("tries", _fits)).alias("pattern"))
    return pairs.join(fits, ["key", "pattern"], "left_semi").select("key", "rule")


def _fits(pattern: Column) -> Column:
    head, tail = delimited("\0").split("\0")
    return F.rlike(F.col("text"), F.concat(F.lit(head), pattern, F.lit(tail)))
