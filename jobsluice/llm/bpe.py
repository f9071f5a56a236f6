"""Byte-level BPE encoding and decoding with a given vocabulary file."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsluice.llm.arrays import STRETCH, pieces
from jobsluice.llm.common import read, text_of

#: Fixed value: the pattern that splits text into words before the merges of byte-level vocabularies.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Code points that newer Unicode tables call letters or numbers and the tokenizers library (0.23) does not yet.
LATE = """
0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7
10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF
18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96
1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479
3D000-3FC3F
"""
NONE = 1 << 30
#: Words of more bytes are merged through a heap, which long runs need; the result is the same.
SHORT = 256
#: So many words of about one length are merged together, row by row of an array; fewer are merged one by one.
TOGETHER = 16
#: Places of such an array; more words are merged in turns.
PLACES = 1 << 17
#: Words or stretches that are looked up at once; a longer text takes several turns.
KEYS = 1 << 18
#: Encoded words that a worker remembers; when so many are held it starts anew.
REMEMBERED = 250_000
#: Vocabulary files are sent to every worker; larger ones are refused.
LARGEST_FILE = 64 << 20


def _remember(known: dict[str, bytes], word: str, ids: bytes) -> None:
    """Keep a short word's ids; long ones are not kept, and so never crowd out the others."""
    if len(known) >= REMEMBERED:
        known.clear()
    known[word] = ids


def _remember_all(known: dict[str, bytes], new: dict[str, bytes]) -> None:
    if max(map(len, new), default=0) > SHORT:
        new = {word: ids for word, ids in new.items() if len(word) <= SHORT}
    if len(known) + len(new) < REMEMBERED:
        known.update(new)
    else:
        for word, ids in new.items():
            _remember(known, word, ids)


def _portions(items: Iterable, most: int) -> Iterator[list]:
    """The items in lists whose lengths sum up to ``most``; a longer item comes alone."""
    some, size = [], 0
    for item in items:
        if some and size + len(item) > most:
            yield some
            some, size = [], 0
        some.append(item)
        size += len(item)
    if some:
        yield some


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files, and the byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shown = {chr(b): b for b in plain}
    return shown | {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}


def late_characters() -> str:
    """The body of a character class of LATE."""
    ranges = [r.split("-") for r in LATE.split()]
    return "".join(f"\\U{int(r[0], 16):08x}-\\U{int(r[-1], 16):08x}" for r in ranges)


class Bpe:
    """A vocabulary with its merges; ``encode`` gives packed little-endian 32-bit ids."""

    def __init__(self, content: bytes) -> None:
        file = json.loads(content)
        letters = byte_letters()
        spell = lambda token: bytes(letters[c] for c in token)
        vocab = file["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in file.get("added_tokens", ())}
        spelled = {i: spell(t) for t, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        size = max(spelled) + 1
        pieces = [spelled.get(i, b"") for i in range(size)]
        self.first = np.full(256, -1, np.int64)
        for token, i in vocab.items():
            if len(token) == 1:
                self.first[letters[token]] = i
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in file["model"]["merges"]):
            self.ranks[vocab[a] << 32 | vocab[b]] = rank
            self.made.append(vocab[a + b])
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.pairs = np.array([*sorted(self.ranks), np.iinfo(np.int64).max], np.int64)
        self.pair_ranks = np.array([self.ranks.get(pair, NONE) for pair in self.pairs.tolist()], np.int32)
        self.outcome = np.array(self.made, np.int32)
        self.split = regex.compile(WORDS)
        late = late_characters()
        apart = WORDS.replace(r"[^\s\p{L}\p{N}]", rf"[^\s[[\p{{L}}\p{{N}}]--[{late}]]]").replace(r" ?\p{L}", rf" ?[\p{{L}}--[{late}]]").replace(r" ?\p{N}", rf" ?[\p{{N}}--[{late}]]")
        self.split_apart, self.late = regex.compile(apart, regex.V1), re.compile(f"[{late}]")
        self.parts = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.gaps = re.compile(r"\s\s")
        self.marks = {t: np.array([i], "<u4").tobytes() for t, i in self.special.items()}
        self.known: dict[str, bytes] = {}
        self.stretches: dict[str, bytes] = {}

    def merge_short(self, ids: list[int]) -> list[int]:
        """Merge by scanning: ids[i] is the part from boundary i to the next, ranks[i] the rank of joining it to its right neighbour."""
        rank = self.ranks.get
        ranks = [rank(a << 32 | b, NONE) for a, b in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) != NONE:
            at = ranks.index(least)
            ids[at] = self.made[least]
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank(ids[at - 1] << 32 | ids[at], NONE)
            if at < len(ranks):
                ranks[at] = rank(ids[at] << 32 | ids[at + 1], NONE)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same merges for long words: a heap of (rank, place) with stale entries passed over."""
        rank, n = self.ranks.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or rank(ids[i] << 32 | ids[j]) != r:
                continue
            ids[i], ids[j], after[i] = self.made[r], -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (x := rank(ids[a] << 32 | ids[b])) is not None:
                    heapq.heappush(heap, (x, a))
        return [i for i in ids if i >= 0]

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of many pairs, NONE where no merge joins them."""
        pairs = a.astype(np.int64) << 32 | b
        at = np.searchsorted(self.pairs, pairs)
        return np.where(self.pairs[at] == pairs, self.pair_ranks[at], NONE)

    def merge_together(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """merge_short on many words of the bytes in ``data``: each is a row of ids and a row of ranks, with an end mark on both
        sides, and each turn makes one merge in every row that has any left. Parts that are gone stay as gaps, stepped over."""
        n, wide, end = len(starts), int(lengths.max()) + 2, len(self.lengths)
        ids = np.full((n, wide), end, np.int32)
        inside = np.arange(wide - 2) < lengths[:, None]
        ids[:, 1:-1][inside] = self.first[data[(starts[:, None] + np.arange(wide - 2))[inside]]]
        if ids.min() < 0:
            raise ValueError("the vocabulary lacks a byte of these words")
        ranks = np.full((n, wide), NONE, np.int32)
        ranks[:, :-1] = self.rank(ids[:, :-1], ids[:, 1:])
        ids = ids.ravel()
        after, before = np.arange(1, n * wide + 1), np.arange(-1, n * wide - 1)
        rows, lines = np.arange(n), np.arange(n) * wide
        while len(rows):
            at = ranks.argmin(axis=1)
            least = ranks[rows, at]
            left = least < NONE
            if not left.all():
                ranks, lines, at, least = ranks[left], lines[left], at[left], least[left]
                rows = np.arange(len(lines))
            a = lines + at
            b = after[a]
            c, z = after[b], before[a]
            made = self.outcome[least]
            ids[a], ids[b] = made, end
            after[a], before[c] = c, a
            ranks[rows, b - lines] = NONE
            ranks[rows, at] = self.rank(made, ids[c])
            ranks[rows, z - lines] = self.rank(ids[z], made)
        kept = ids != end
        packed = ids[kept].astype("<u4").tobytes()
        ends = (4 * np.cumsum(kept.reshape(n, wide).sum(axis=1))).tolist()
        return [packed[i:j] for i, j in zip([0, *ends], ends)]

    def merged(self, words: set[str]) -> dict[str, bytes]:
        """The ids of each word; words of about one length are merged together."""
        words = list(words)
        coded = pa.array(words, pa.large_string())
        bounds = np.frombuffer(coded.buffers()[1], np.int64)[: len(words) + 1]
        data = np.frombuffer(coded.buffers()[2] or b"", np.uint8)
        lengths = np.diff(bounds)
        out, width = {}, 8
        alone = lengths > SHORT
        while width <= SHORT:
            group = np.flatnonzero((lengths <= width) & (lengths > (width >> 1 if width > 8 else 0)))
            if len(group) < TOGETHER:
                alone[group] = True
            else:
                for some in np.array_split(group, -(-len(group) * width // PLACES)):
                    out |= zip([words[i] for i in some.tolist()], self.merge_together(data, bounds[some], lengths[some]))
            width *= 2
        return out | {words[i]: self.word(words[i]) for i in np.flatnonzero(alone).tolist()}

    def word(self, word: str) -> bytes:
        ids = self.first[np.frombuffer(word.encode(), np.uint8)].tolist()
        ids = self.merge_short(ids) if len(ids) <= SHORT else self.merge_long(ids)
        return np.array(ids, "<u4").tobytes()

    def words(self, text: str) -> list[str]:
        split = self.split if text.isascii() or not self.late.search(text) else self.split_apart
        return split.findall(text)

    def cut(self, text: str) -> list[tuple[dict[str, bytes], list[str]]]:
        """A text as runs of keys, each with the table of their ids: special tokens, words or stretches.

        In a part without two white spaces in a row a space always begins a new word, so that the stretches between spaces
        can be looked up whole; only its last one may end in a white space, and is cut into words.
        """
        runs = []
        for part in self.parts.split(text) if any(token in text for token in self.special) else (text,):
            if part in self.special:
                runs.append((self.marks, [part]))
            elif self.gaps.search(part):
                runs.append((self.known, self.words(part)))
            else:
                first, *rest = part.split(" ")
                last = self.words(" " + rest.pop()) if rest and part[-1].isspace() else []
                runs += [(self.known, self.words(first)), (self.stretches, rest), (self.known, last)]
        return [(table, keys[i : i + KEYS]) for table, keys in runs for i in range(0, len(keys), KEYS)]

    def look_up(self, table: dict[str, bytes], runs: list[list[str]], find: Callable[[set[str]], dict[str, bytes]]) -> list[list[bytes]]:
        """The ids of each run's keys, remembered or found."""
        known = [list(map(table.get, run)) for run in runs]
        absent = {key for run, ids in zip(runs, known) for key, x in zip(run, ids) if x is None}
        new = find(absent) if absent else {}
        _remember_all(table, new)
        return [[new[key] if x is None else x for key, x in zip(run, ids)] if None in ids else ids for run, ids in zip(runs, known)]

    def of_stretches(self, stretches: set[str]) -> dict[str, bytes]:
        """The ids of stretches, each with a space before it, which begins a word; so they are split as one text."""
        words = self.words(" " + " ".join(stretches))
        firsts = [i for i, word in enumerate(words) if word[0] == " "]
        (ids,) = self.look_up(self.known, [words], self.merged)
        return {s: ids[i] if j == i + 1 else b"".join(ids[i:j]) for s, i, j in zip(stretches, firsts, [*firsts[1:], len(words)], strict=True)}

    def encode_some(self, texts: list[str]) -> list[bytes]:
        """Ids of some texts: what is new in any of them is merged together, then each text is put together."""
        cuts = [self.cut(text) for text in texts]

        def ids(table: dict[str, bytes], find: Callable[[set[str]], dict[str, bytes]]) -> Iterator[bytes]:
            for some in _portions((run for cut in cuts for of, run in cut if of is table), KEYS):
                yield from map(b"".join, self.look_up(table, some, find))

        found = {id(table): ids(table, find) for table, find in ((self.marks, dict), (self.known, self.merged), (self.stretches, self.of_stretches))}
        return [b"".join(next(found[id(table)]) for table, _ in cut) for cut in cuts]

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text, a bounded stretch of texts at a time; a longer text is worked on alone."""
        for some in _portions(texts, STRETCH):
            yield from self.encode_some(some)

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4").astype(np.int64)
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.bytes[at].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _model(content: bytes) -> Bpe:
    return Bpe(content)


def vocabulary(spark: SparkSession, path: str) -> Callable[[], Bpe]:
    """The vocabulary file at ``path`` (read by the driver), ready on any worker."""
    with open(path, "rb") as file:
        content = file.read(LARGEST_FILE + 1)
    if len(content) > LARGEST_FILE:
        raise ValueError(f"{path} has more than {LARGEST_FILE} bytes")
    sent = spark.sparkContext.broadcast(content)
    return lambda: _model(sent.value)


def _ids(bpe: Bpe, texts: pa.Array) -> pa.Array:
    return pa.array(bpe.encode_all(texts.to_pylist()), pa.binary())


def _texts(bpe: Bpe, ids: pa.Array) -> pa.Array:
    return pa.array([bpe.decode(x or b"") for x in ids.to_pylist()], pa.string())


def _texts_of(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return rows, f"id {rows.schema['id'].dataType.simpleString()}"


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ids (binary: little-endian unsigned 32-bit token ids) of each row's whole text.

    Special tokens' strings in a text become their ids. Null and empty texts have no tokens. Repeated rows, null ids
    and an empty table pass through row by row; other columns are not read.
    """
    model = vocabulary(docs.sparkSession, path)
    rows, schema = _texts_of(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), _ids(model(), batch.column(1))], ["id", "ids"])

    return rows.mapInArrow(run, f"{schema}, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded``, the text of ``ids``; bytes that are no UTF-8 become U+FFFD. Null ids decode as none."""
    model = vocabulary(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, _texts(model(), batch.column(1))], ["id", "ids", "decoded"])

    rows = encoded.select("id", "ids")
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids binary, decoded string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids and decoded: decode of encode, in one pass of one worker. The cases are those of encode."""
    model = vocabulary(docs.sparkSession, path)
    rows, schema = _texts_of(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            ids = _ids(model(), batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, _texts(model(), ids)], ["id", "ids", "decoded"])

    return rows.mapInArrow(run, f"{schema}, ids binary, decoded string")


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row's encoded and decoded text."""
    return round_trip(docs, path).select(
        F.col("id").alias("doc_id"),
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(read(spark, sf_dir, "documents"), default_vocabulary())
