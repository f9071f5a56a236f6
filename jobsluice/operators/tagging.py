"""Tags from a table of rules."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsluice.functions.text import delimited

#: A pattern of this form is a list of plain words, which are looked up among the text's words.
PLAIN = re.compile(r"[a-z0-9]+(\|[a-z0-9]+)*")


class Rule(NamedTuple):
    """A tag with its patterns. ``include`` and ``exclude`` are matched as whole words in the lower-cased text;
    ``second`` may hold in another column instead."""

    tag: str
    priority: int
    include: str
    exclude: str | None = None
    second: str | None = None


def rules_of(table: DataFrame) -> list[Rule]:
    """Rules of a table with Rule's columns, by priority and tag. The table is configuration and read whole."""
    return [Rule(*r) for r in table.select(*Rule._fields).orderBy("priority", "tag").collect()]


def tags(rules: list[Rule], text: Column, other: Column | None = None, guarded: bool = True) -> Column:
    """Sorted array of the tags whose rules hold, in one narrow pass over the rows, without a join.

    The text is split into words once, and those that any rule names are kept: most rules are lists of plain words and
    look into that short list only. The other patterns are matched behind one that fits wherever any of them does.
    """
    used = [p for r in rules for p in (r.include, r.exclude if guarded else None) if p]
    plain = sorted({w for p in used if PLAIN.fullmatch(p) for w in p.split("|")})
    others = sorted({p for p in used if not PLAIN.fullmatch(p)})
    split = F.split(text, r"[^\p{L}\p{N}]+")
    named = F.array_intersect(split, F.array(*map(F.lit, plain))) if plain else F.array().cast("array<string>")
    any_other = text.rlike(delimited("|".join(f"(?:{p})" for p in others))) if others else F.lit(False)

    def held_in(found: Column) -> Column:
        words, other_fits = found["words"], found["other"]

        def fits(pattern: str) -> Column:
            if PLAIN.fullmatch(pattern):
                hit = F.arrays_overlap(words, F.array(*map(F.lit, pattern.split("|"))))
            else:
                hit = other_fits & text.rlike(delimited(pattern))
            return F.coalesce(hit, F.lit(False))

        held = []
        for r in rules:
            hit = fits(r.include)
            if r.second and other is not None:
                hit = hit | F.coalesce(other.rlike(r.second), F.lit(False))
            if r.exclude and guarded:
                hit = hit & ~fits(r.exclude)
            held.append(F.when(hit, F.lit(r.tag)))
        return F.filter(F.array(*held), lambda t: t.isNotNull())

    found = F.array(F.struct(named.alias("words"), F.coalesce(any_other, F.lit(False)).alias("other")))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(found, held_in))))


def primary(rules: list[Rule], tagged: Column, default: str = "general") -> Column:
    """The tag of the smallest priority, of equal ones the first by name."""
    order = [r.tag for r in sorted(rules, key=lambda r: (r.priority, r.tag))]
    return F.coalesce(*(F.when(F.array_contains(tagged, t), F.lit(t)) for t in order), F.lit(default))


def contingency(rows: DataFrame, old: Column, new: Column) -> DataFrame:
    """old_tag, new_tag, n: how rows move between two rule tables."""
    return rows.groupBy(old.alias("old_tag"), new.alias("new_tag")).agg(F.count(F.lit(1)).alias("n"))


def drift(rows: DataFrame, period: str, tag: str, threshold: float) -> DataFrame:
    """period, tag, share, change, flagged: each tag's share of its period against the last period in which it occurs."""
    counts = rows.groupBy(period, tag).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy(period))
    shares = counts.withColumn("share", share)
    change = F.col("share") - F.lag("share").over(Window.partitionBy(tag).orderBy(period))
    return shares.select(period, tag, "share", change.alias("change")).withColumn("flagged", F.coalesce(F.abs("change") > threshold, F.lit(False)))


def residue(rows: DataFrame, text: Column, k: int) -> DataFrame:
    """token, n: the k most frequent words of rows that no rule tagged."""
    words = rows.select(F.explode(F.split(F.lower(text), r"[ \t\n\r\.,]+")).alias("token")).filter("token <> ''")
    return words.groupBy("token").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "token").limit(k)


def stratified(rows: DataFrame, stratum: str, key: str, per: int) -> DataFrame:
    """``per`` rows of each stratum, in the order of a modulus of their key, which any engine can follow."""
    order = Window.partitionBy(stratum).orderBy((F.col(key) * 7919) % 10007, key)
    return rows.withColumn("_k", F.row_number().over(order)).filter(F.col("_k") <= per).drop("_k")


def quality(predicted: Column, label: Column) -> list[Column]:
    """Aggregates: true and false positives, false negatives, precision and recall."""
    tp, fp, fn = (F.count_if(c) for c in (predicted & label, predicted & ~label, ~predicted & label))
    ratio = lambda a, b: F.when(b > 0, F.round(a / b, 6))
    return [tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall")]
