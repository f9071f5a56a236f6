"""Exact deduplication: groups by a 128-bit content hash, split further by the bytes of the texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsluice.llm.common import BROADCAST_IDS, SPACES, join_counted, read, stored, text_of


def leading_128_bits(sha: Column) -> Column:
    """The first half of a SHA-256 digest given as 32 bytes."""
    return F.substring(sha, 1, 16)


def _keyed(docs: DataFrame, id_col: str, text_col: str, hash128: Callable[[Column], Column], *more: Column) -> DataFrame:
    norm = F.regexp_replace(text_of(text_col), f"[{SPACES}]+", " ")
    rows = docs.select(F.col(id_col).alias("id"), norm.alias("norm"), *more)
    rows = rows.withColumn("sha", F.unhex(F.sha2("norm", 256)))
    return rows.withColumn("h", hash128(F.col("sha")))


def _listed(rows: DataFrame, ids: DataFrame, id_col: str, how: str) -> DataFrame:
    """``rows`` with (left_semi) or without (left_anti) an id in the stored table ``ids``; null ids are ids."""
    small = ids.select(F.col("id").alias("listed id"))
    small = F.broadcast(small) if ids.count() <= BROADCAST_IDS else small
    return rows.join(small, F.col(id_col).eqNullSafe(F.col("listed id")), how)


def _groups(docs: DataFrame, id_col: str, text_col: str, hash128: Callable[[Column], Column]) -> DataFrame:
    """exact_groups: digests first, then the bytes of the texts whose hash another row shares."""
    digests = stored(_keyed(docs, id_col, text_col, hash128).select("id", "h", "sha", F.xxhash64("h").alias("k")), "digests")
    shared = stored(digests.groupBy("k", "h").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1"), "shared")
    total = shared.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    ids = stored(join_counted(digests, shared, ["k", "h"], "rows", total, ["id", "sha"]).select("id").distinct(), "ids")
    texts = _keyed(_listed(docs, ids, id_col, "left_semi"), id_col, text_col, hash128)
    # The hash leads the key and the bytes follow. The aggregate runs before the shuffle too: of a large group each
    # task sends one row.
    classes = texts.groupBy("h", "norm").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    classes = stored(classes.filter("group_size > 1").select(F.xxhash64("h").alias("k"), "h", F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "group_size"), "classes")
    found = join_counted(digests, classes, ["k", "h", "sha"], "group_size", total, ["id"], outer=True).withColumn("group_size", F.coalesce("group_size", F.lit(1)).cast("long"))
    keep = F.when(F.col("group_size") > 1, F.col("keep_id")).otherwise(F.col("id"))
    return found.select("id", keep.alias("keep_id"), "group_size", F.col("id").eqNullSafe(keep).alias("kept"), "sha")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash128: Callable[[Column], Column] = leading_128_bits) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, sha (32 bytes of the normalised text).

    Texts are equal when their bytes are after each run of ASCII white space became one space; leading and trailing
    runs count, as one space. The row with the smallest id stays. Null and empty texts are one group. Null ids sort
    last: they stay only where no row of the group has an id. Rows that repeat id and text are one document, all
    marked alike. An empty table gives no rows; other columns are not read.

    ``hash128`` makes the group hash from the SHA-256 bytes; a weak one only costs time. Only texts whose hash occurs
    twice cross a shuffle; rows find their group by digests alone, those of a large group without a shuffle.
    """
    return _groups(docs, id_col, text_col, hash128)


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash128: Callable[[Column], Column] = leading_128_bits) -> DataFrame:
    """The rows of ``docs`` that stay, one per distinct text, with their columns; see exact_groups for the cases.

    Of rows that repeat id and text one stays. Rows are left out by id, without a shuffle of their texts, where one text
    stands under the id; those whose id has a row that goes and one that stays, or one twice, are told apart by digest.
    """
    groups = stored(_groups(docs, id_col, text_col, hash128), "groups")
    ids = groups.groupBy("id").agg(F.count(F.lit(1)).alias("rows"), F.count_if("kept").alias("keeps"))
    gone = stored(ids.filter("keeps < rows or keeps > 1").select("id", (F.col("keeps") > 0).alias("some")), "gone")
    rows = _listed(docs, gone, id_col, "left_anti")
    mixed = stored(gone.filter("some").select("id"), "mixed")
    keepers = groups.filter("kept").select(F.col("id").alias("keep id"), F.col("sha").alias("keep sha")).distinct()
    part = _keyed(_listed(docs, mixed, id_col, "left_semi"), id_col, text_col, hash128, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    part = part.join(keepers, F.col("id").eqNullSafe(F.col("keep id")) & (F.col("sha") == F.col("keep sha")), "left_semi")
    return rows.unionByName(part.dropDuplicates(["id", "sha"]).select("row.*"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_groups(read(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


ORACLE = r"""
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
"""
