"""Places: canonical names, aliases, postings in several places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Alias tables of more rows are joined by Spark's choice instead of a broadcast.
LARGEST_ALIASES = 100_000


def display_place(locality: Column, region: Column, country: Column) -> Column:
    """``locality, region, country``; missing and empty parts and a region that repeats the locality are left out."""
    part = lambda c: F.nullif(F.trim(c), F.lit(""))
    again = part(region).eqNullSafe(part(locality))
    return F.concat_ws(", ", part(locality), F.when(~again, part(region)), part(country))


def resolve_country(places: DataFrame, place: str, aliases: DataFrame) -> DataFrame:
    """Adds ``country``: of all aliases (alias, country) whose words follow each other in the place, the longest; else null.

    Words are matched ignoring case and accents of any script, by an equi-join of the place's stretches of up to as many
    words as the longest alias has; nothing is compared with every alias. Stretches end at commas.
    """
    listed = aliases.select(F.array_join(_words(F.col("alias")), " ").alias("_alias"), "country").filter("_alias <> ''")
    longest, n = listed.agg(F.max(F.size(F.split("_alias", " "))), F.count(F.lit(1))).first()
    keyed = listed.select(_folded("_alias"), "country").groupBy("_alias").agg(F.min("country").alias("_country"))
    small = F.broadcast(keyed) if n <= LARGEST_ALIASES else keyed
    distinct = places.select(place).distinct()
    parts = distinct.select(place, F.explode(F.split(place, ",")).alias("_p")).select(place, _words(F.col("_p")).alias("_w")).filter(F.size("_w") > 0)
    starts = parts.select(place, "_w", F.explode(F.sequence(F.lit(1), F.size("_w"))).alias("_s"))
    lengths = F.sequence(F.lit(1), F.least(F.lit(longest or 1), F.size("_w") - F.col("_s") + 1))
    stretches = starts.select(place, "_w", "_s", F.explode(lengths).alias("_n")).select(place, F.array_join(F.slice("_w", F.col("_s"), F.col("_n")), " ").alias("_alias"))
    found = stretches.select(place, F.length("_alias").alias("_l"), _folded("_alias")).join(small, "_alias")
    best = found.groupBy(place).agg(F.max_by("_country", F.struct("_l", "_country")).alias("country"))
    return places.join(best, place, "left")


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[^\p{L}\p{N}\p{M}]+"), lambda w: w != "")


def _folded(name: str) -> Column:
    """The column compared without case and accents."""
    return F.collate(F.col(name), "UNICODE_CI_AI").alias(name)


def places_of(rows: DataFrame, key: str, places: str) -> DataFrame:
    """key, place: one row for each distinct place of an array."""
    return rows.select(key, F.explode(F.array_distinct(places)).alias("place"))


def in_any_place(places: Column, wanted: list[str]) -> Column:
    return F.arrays_overlap(places, F.array(*map(F.lit, wanted)))
