"""A seen table behind a Bloom filter: most rows and most of the table never meet in a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a word of the filter that a key sets.
BITS = 6
#: Keys for each word of 64 bits, and the most words: two numbers each, so that a filter has 64 MB or less.
KEYS_PER_WORD, MOST_WORDS = 6, 1 << 21


def _word(keys: list[str], words: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("word"), *keys), F.lit(words))


def _mask(keys: list[str]) -> Column:
    """BITS of the 64, from six bits of another hash each."""
    h = F.xxhash64(F.lit("mask"), *keys)
    one = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * k).bitwiseAND(63).cast("int"))
    mask = one(0)
    for k in range(1, BITS):
        mask = mask.bitwiseOR(one(k))
    return mask


def words_for(n: int) -> int:
    """Words of a filter for n keys; beyond MOST_WORDS it lets more through, and stays right."""
    return max(1, min(MOST_WORDS, -(-n // KEYS_PER_WORD)))


def filter_of(rows: DataFrame, keys: list[str], words: int) -> DataFrame:
    """word, bits: the filter of the rows' keys, at most ``words`` rows. Filters of as many words merge by merged_filters."""
    return rows.select(_word(keys, words).alias("word"), _mask(keys).alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("bits"))


def merged_filters(*filters: DataFrame) -> DataFrame:
    """The filter of the keys of any of the filters, which have as many words."""
    rows = filters[0]
    for other in filters[1:]:
        rows = rows.unionByName(other)
    return rows.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def perhaps(rows: DataFrame, keys: list[str], listed: DataFrame, words: int) -> DataFrame:
    """``rows`` with ``_perhaps``: false only where the key is surely not in the filter. The filter is broadcast."""
    probe = rows.withColumn("_word", _word(keys, words)).withColumn("_mask", _mask(keys))
    found = probe.join(F.broadcast(listed.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))), "_word", "left")
    hit = F.coalesce(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False))
    return found.select(*rows.columns, hit.alias("_perhaps"))


def drop_seen_by_filter(rows: DataFrame, seen: DataFrame, keys: list[str], seen_filter: DataFrame, words: int) -> DataFrame:
    """Rows whose key is not in ``seen``, of which ``seen_filter`` is the filter; null keys are equal to null keys.

    Rows that the filter does not know stay without a join. The keys of the others make a filter of their own, which ``seen``
    passes before its shuffle: what is joined is little of either side, and exact.
    """
    judged = perhaps(rows, keys, seen_filter, words)
    open_rows = judged.filter("_perhaps").drop("_perhaps")
    few = perhaps(seen.select(*keys), keys, filter_of(open_rows, keys, words), words).filter("_perhaps").drop("_perhaps").distinct()
    few = few.select(*[F.col(k).alias(f"_seen_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_seen_{k}")) for k in keys]
    return judged.filter("not _perhaps").drop("_perhaps").unionByName(open_rows.join(few, same, "left_anti"))
