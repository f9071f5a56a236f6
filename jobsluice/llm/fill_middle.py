"""Fill-in-middle: texts cut at line ends into prefix, middle and suffix, and put together in another order."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from jobsluice.llm.common import read, text_of

#: Bytes of a text that one leaf of the tree counts.
BLOCK = 512
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = f"{PREFIX}|{SUFFIX}|{MIDDLE}"
NEWLINE = 10
CUT = StructType([StructField(name, LongType()) for name in ("n", "prefix_chars", "middle_chars")])


class LineTree:
    """Where the lines of a text end: a Fenwick tree over blocks of its UTF-8 bytes, which holds lines and code points.

    A line is ``[^\\n]*\\n|[^\\n]+``. Place i of a tree sums the blocks up to the i-th, as many as the lowest set bit of i.
    """

    def __init__(self, data: np.ndarray) -> None:
        self.data = data
        ends = data == NEWLINE
        if len(data):
            ends[-1] = True
        self.ends = ends
        starts = np.arange(0, len(data), BLOCK)
        count = lambda flags: np.add.reduceat(flags.view(np.uint8), starts, dtype=np.int64) if len(data) else np.zeros(0, np.int64)
        self.trees = [self._tree(count(flags)) for flags in (ends, (data & 0xC0) != 0x80)]
        self.lines = int(np.count_nonzero(ends))

    @staticmethod
    def _tree(leaves: np.ndarray) -> np.ndarray:
        """Each place adds itself to the next one that covers it, the lowest set bits first."""
        tree = np.concatenate(([0], leaves))
        step = 1
        while step < len(tree):
            below = np.arange(step, len(tree) - step, 2 * step)
            tree[below + step] += tree[below]
            step *= 2
        return tree

    def cut(self, line: int) -> tuple[int, int]:
        """(bytes, code points) up to the end of the line-th line; 0 is the beginning.

        The descent finds the last block before which fewer lines end; within the next one ends are counted.
        """
        if line <= 0:
            return 0, 0
        lines, points = self.trees
        place, seen, chars = 0, 0, 0
        step = 1 << (len(lines).bit_length() - 1)
        while step:
            nxt = place + step
            if nxt < len(lines) and seen + lines[nxt] < line:
                place, seen, chars = nxt, seen + int(lines[nxt]), chars + int(points[nxt])
            step >>= 1
        first = place * BLOCK
        within = np.flatnonzero(self.ends[first : first + BLOCK])[line - seen - 1] + 1
        return first + int(within), chars + int(np.count_nonzero((self.data[first : first + within] & 0xC0) != 0x80))


@F.arrow_udf(CUT)
def _cuts(texts: pa.Array, one: pa.Array, other: pa.Array) -> pa.Array:
    """Lines of each text, and the code points before and between the two cuts that the numbers choose."""
    large = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if large else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)
    out = []
    for start, end, a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), one.to_pylist(), other.to_pylist()):
        tree = LineTree(data[start:end])
        low, high = sorted((a % (tree.lines + 1), b % (tree.lines + 1)))
        first, second = tree.cut(low)[1], tree.cut(high)[1]
        out.append((tree.lines, first, second - first))
    return pa.StructArray.from_arrays([pa.array([row[i] for row in out], pa.int64()) for i in range(3)], CUT.names)


def _group(digest: Column, k: int) -> Column:
    """The k-th group of eight hexadecimal digits as a number, from 1."""
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, seed: int, rate: int = 100, spm: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n (lines), form, prefix_chars, middle_chars, output: every whole text with its middle moved to the end.

    A digest of ``seed`` and the id (a null id: nothing after the colon) chooses both cuts and the form: ``rate`` of a hundred
    texts are cut, ``spm`` of a hundred of these have the suffix first. Texts that are empty or null or hold a mark stay
    plain. Repeated rows are cut alike; an empty table gives no rows; other columns are not read.
    """
    text = text_of(text_col)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), digest.alias("digest"))
    rows = rows.select("id", "text", *[_group(F.col("digest"), k).alias(f"h{k}") for k in (1, 2, 3, 4)])
    rows = rows.withColumn("cut", _cuts("text", "h1", "h2"))
    plain = (F.col("text") == "") | F.col("text").rlike(MARKS) | (F.col("h3") % 100 >= rate)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm, "spm").otherwise("psm")
    rows = rows.select("id", "text", "cut", form.alias("form"))
    first, second = F.col("cut.prefix_chars").cast("int"), F.col("cut.middle_chars").cast("int")
    prefix, middle = F.substring("text", F.lit(1), first), F.substring("text", first + 1, second)
    suffix = F.substring("text", first + second + 1, F.length("text"))
    p, s, m = (F.lit(x) for x in (PREFIX, SUFFIX, MIDDLE))
    output = F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle)).when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(F.col("text"))
    cut = F.col("form") != "plain"
    return rows.select("id", "cut.n", "form", F.when(cut, F.col("cut.prefix_chars")).alias("prefix_chars"), F.when(cut, F.col("cut.middle_chars")).alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from. No text that is cut holds a mark, and no cut makes one."""
    part = lambda i: F.get(F.split(output, MARKS, -1), F.lit(i))
    return F.when(form == "psm", F.concat(part(1), part(3), part(2))).when(form == "spm", F.concat(part(2), part(3), part(1))).otherwise(output)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle(read(spark, sf_dir, "documents"), seed=7)
    return rows.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS h FROM documents),
u AS (SELECT *, length(text) - length(replace(text, chr(10), '')) + CASE WHEN text = '' OR suffix(text, chr(10)) THEN 0 ELSE 1 END AS n, string_split(text, chr(10)) AS lines,
    ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM t),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM u),
f AS (SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
    CASE WHEN a = 0 THEN 0 WHEN a = n THEN length(text) ELSE length(array_to_string(lines[1:a], chr(10))) + 1 END AS x,
    CASE WHEN b = 0 THEN 0 WHEN b = n THEN length(text) ELSE length(array_to_string(lines[1:b], chr(10))) + 1 END AS y FROM c),
p AS (SELECT *, substr(text, 1, x) AS pre, substr(text, x + 1, y - x) AS mid, substr(text, y + 1) AS suf FROM f)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256 FROM p
"""
