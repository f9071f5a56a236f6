"""From documents to token ids: language, copies, near copies, benchmark passages, then encoding.

Each stage reads what the stage before it wrote, and works on all of it. Further columns pass through the first four
stages whatever their names; an empty table gives an empty one at each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsluice.llm import bpe, decontaminate, exact_dedup, jaccard_join, language
from jobsluice.llm.common import read, stored

#: No SQL: languages are learnt, and the last stage encodes with a vocabulary file.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns languages from the documents that name theirs, and lets those go whose language is unknown or not as stated.

    A document goes if its text is null, empty or without letters, if it is surely of another learnt language than the one
    it states, or if it is long and near none. A null language states nothing. Repeated rows and ids, null ones too, are
    judged one by one.
    """
    return language.keep_identified(docs, language.learn(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays, of rows that repeat id and text one.

    Null and empty texts are equal. A null id stays only where no equal text has one.
    """
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents (five-word shingles, similarity 0.8) the one with the smallest id stays.

    Null and empty texts have no words and no links. Rows that repeat an id, null ones too, stay or go together; the null
    id comes first.
    """
    return jaccard_join.keep_one_of_each(docs, jaccard_join.Rule(size=5, least=80))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document goes if one in twenty of its words or more stands in a passage of the benchmark.

    Null and empty texts have no words and stay. Rows that repeat an id, null ones too, are judged together: they go if any
    of them would.
    """
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit), and the digest of the text that decoding gives.

    Null and empty texts have no ids. Repeated rows and null ids are encoded row by row.
    """
    rows = bpe.round_trip(docs, bpe.default_vocabulary())
    return rows.select(F.col("id").alias("doc_id"), F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
