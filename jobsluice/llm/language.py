"""Language identification by hyperdimensional profiles of letter trigrams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsluice.llm.arrays import pieces, random_u64
from jobsluice.llm.common import read, text_of

DIMENSIONS = 512
#: Documents and letters whose trigrams are counted at once.
BLOCK_ROWS, BLOCK_LETTERS = 256, 1 << 20
#: Languages that a model may have; their profiles go to every worker.
MOST_LANGUAGES = 2000
UNKNOWN = "und"
#: Unit vectors are summed as whole numbers of this fraction, so that sums do not depend on their order.
STEP = 1 << 20
#: A prediction of at least this cosine, and so much nearer than the stated language, refutes the statement.
SURE, LEAD = 0.5, 0.2
#: A text of at least so many characters whose cosine is below this is in none of the languages.
LONG_TEXT, FOREIGN = 300, 0.2


class Profiles(NamedTuple):
    """Languages in order and their prototypes, unit vectors by row."""

    names: list[str]
    vectors: np.ndarray


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=50_000)
def letter_vector(code: int) -> np.ndarray:
    """The fixed random vector of +1 and -1 of a letter (0: what stands around words)."""
    bits = random_u64(DIMENSIONS // 64, code + 1).view(np.uint8)
    return (np.unpackbits(bits).astype(np.int8) << 1) - 1


def _trigram_vectors(a: np.ndarray, b: np.ndarray, c: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """Bound vectors: the first letter's permuted twice, the second's once, multiplied by the third's."""
    table = np.stack([letter_vector(int(x)) for x in alphabet])
    return np.roll(table, 2, axis=1)[a] * np.roll(table, 1, axis=1)[b] * table[c]


def bundle(texts: list[str]) -> np.ndarray:
    """The bundled vector of each text's trigrams (rows; zeros without letters), as float32."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    small = [t.lower() for t in texts]
    codes = np.frombuffer(("\n" + "\n".join(small) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts) + 1), [1, *(len(t) + 1 for t in small)]) - 1
    letter = _letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    codes, owner = np.where(letter, codes, 0)[keep], owner[keep]
    if len(codes) < 3:
        return out
    used = np.zeros(int(codes.max()) + 1, bool)
    used[codes] = True
    alphabet = np.flatnonzero(used)
    place = np.cumsum(used) - 1
    x, n = place[codes], len(alphabet)
    a, b, c, owner = x[:-2], x[1:-1], x[2:], owner[1:-1]
    middle = codes[1:-1] != 0
    key, owner = ((a * n + b) * n + c)[middle], owner[middle]
    if not len(key):
        return out
    if n <= 200:
        seen = np.zeros(n**3, bool)
        seen[key] = True
        kinds = np.flatnonzero(seen)
        rank = np.cumsum(seen, dtype=np.int64) - 1
        key = rank[key]
    else:
        kinds, key = np.unique(key, return_inverse=True)
    for first in range(0, len(kinds), 8192):  # so that the counts stay small with large alphabets
        part = kinds[first : first + 8192]
        inside = (key >= first) & (key < first + len(part)) if len(kinds) > 8192 else slice(None)
        counts = np.bincount(owner[inside] * len(part) + key[inside] - first, minlength=len(texts) * len(part))
        vectors = _trigram_vectors(part // (n * n), part // n % n, part % n, alphabet)
        out += counts.reshape(len(texts), -1).astype(np.float32) @ vectors.astype(np.float32)
    return out


def unit(vectors: np.ndarray) -> np.ndarray:
    length = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
    return np.divide(vectors, length, out=np.zeros(vectors.shape, np.float64), where=length > 0)


def _blocks(texts: list[str]) -> Iterator[slice]:
    """Successive rows, few enough to count at once."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if i > first and (i - first >= BLOCK_ROWS or size + len(text) > BLOCK_LETTERS):
            yield slice(first, i)
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield slice(first, len(texts))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the unit vectors of each language in the partition, as (lang, place, total)."""
    sums: dict[str, np.ndarray] = {}
    for batch in pieces(batches):
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for rows in _blocks(texts):
            vectors = np.rint(unit(bundle(texts[rows])) * STEP).astype(np.int64)
            for lang in set(langs[rows]):
                part = vectors[[x == lang for x in langs[rows]]].sum(axis=0)
                sums[lang] = sums[lang] + part if lang in sums else part
    for lang, total in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * DIMENSIONS, pa.string()), pa.array(np.arange(DIMENSIONS), pa.int32()), pa.array(total, pa.int64())], ["lang", "place", "total"])


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Prototypes from all rows of ``labelled`` with a language: the bundled unit vectors of its texts.

    Rows without language, text or letters add nothing; without any row there are no languages. Every text is read
    whole; of each partition and language one vector goes on. Only the finished prototypes reach the driver.
    """
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).filter("lang is not null and text is not null")
    sums = rows.mapInArrow(_sums, "lang string, place int, total bigint").groupBy("lang", "place").agg(F.sum("total").alias("total"))
    found = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "total"))).alias("v")).select("lang", "v.total").limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    found = sorted((r["lang"], r["total"]) for r in found if any(r["total"]))
    return Profiles([lang for lang, _ in found], unit(np.array([v for _, v in found], np.float64).reshape(len(found), DIMENSIONS)))


def _cosines(profiles: Profiles, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Of each text the cosine with every language, and whether it has letters to tell one by."""
    near, known = [np.zeros((0, len(profiles.names)))], [np.zeros(0, bool)]
    for rows in _blocks(texts):
        vectors = unit(bundle(texts[rows]))
        near.append(vectors @ profiles.vectors.T)
        known.append(vectors.any(axis=1) & bool(profiles.names))
    return np.concatenate(near), np.concatenate(known)


def _nearest(profiles: Profiles, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The language of each text and its cosine."""
    near, known = _cosines(profiles, texts)
    if not profiles.names:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    best = near.argmax(axis=1)
    langs = [profiles.names[b] if k else UNKNOWN for b, k in zip(best, known)]
    return langs, np.where(known, np.clip(near[np.arange(len(best)), best], 0, 1), 0.0)


def _kept(profiles: Profiles, texts: list[str], stated: list[str | None]) -> np.ndarray:
    near, known = _cosines(profiles, texts)
    if not profiles.names:
        return known
    best = near.max(axis=1)
    place = {name: k for k, name in enumerate(profiles.names)}
    own = np.array([near[i, place[x]] if x in place else np.inf for i, x in enumerate(stated)])
    refuted = (best >= SURE) & (best - own >= LEAD)
    foreign = (np.array([len(t) for t in texts]) >= LONG_TEXT) & (best < FOREIGN)
    return known & ~refuted & ~foreign


def identify(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score of each row of ``docs``: the language of the nearest prototype and its cosine.

    ``und`` with score 0 stands for texts that are null or have no letter, and for all without prototypes. Of equally
    near languages the first by name wins. Rows pass one by one: repeats, null ids and empty tables are as they are.
    """
    sent = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            langs, scores = _nearest(sent.value, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double")


def keep_identified(docs: DataFrame, profiles: Profiles, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs``, with their columns, whose language is known and as stated.

    Rows go whose text is null, empty or without letters; whose text is surely of another language than the learnt one
    they state (its cosine is SURE or more, and LEAD more than that of the stated one); and long texts that are near
    none of the languages. A null or unlearnt language states nothing, nor does a table without the column. Rows pass one
    by one: repeats, ties of ids, further columns and empty tables are as they are. Without any language all rows go.
    """
    sent = docs.sparkSession.sparkContext.broadcast(profiles)
    place = docs.columns.index(text_col)
    stated = docs.columns.index(lang_col) if lang_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            langs = [None] * batch.num_rows if stated is None else batch.column(stated).to_pylist()
            yield batch.filter(pa.array(_kept(sent.value, [t or "" for t in batch.column(place).to_pylist()], langs), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def fold(id_col: str, folds: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    profiles = learn(docs.filter(F.coalesce(fold("doc_id", 3), F.lit(0)) != 1))
    rows = identify(docs, profiles)
    return rows.select(F.col("id").alias("doc_id"), F.coalesce(fold("id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
