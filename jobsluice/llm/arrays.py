"""Texts as numpy arrays, a bounded stretch at a time: words, their hashes, and n-grams of words."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a longer text is worked on alone.
STRETCH = 1 << 20
MASK = (1 << 64) - 1


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows, so that little of a batch is held as Python objects."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them evenly (the finalizer of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_u64(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    return mixed((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * np.uint64(0x9E3779B97F4A7C15))


@lru_cache(maxsize=4)
def powers(n: int) -> np.ndarray:
    out = np.full(n, 0xD6E8FEB86659FD93, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@lru_cache(maxsize=4)
def byte_values(lower: bool, letters: bool = False) -> np.ndarray:
    """A random value for each byte, none for white space; with ``lower`` A-Z have those of a-z.

    With ``letters`` all of ASCII but letters and digits is white space.
    """
    out = random_u64(256, 7)
    out[[0x20, *range(0x09, 0x0E)]] = 0
    if letters:
        out[[b for b in range(128) if not chr(b).isalnum()]] = 0
    if lower:
        out[0x41:0x5B] = out[0x61:0x7B]
    return out


class Words(NamedTuple):
    """Words of some texts: 64-bit hash, first byte and byte after the last, and where each text's words begin."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    firsts: np.ndarray
    data: np.ndarray


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False, letters: bool = False) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the texts data[offsets[i]:offsets[i + 1]] in UTF-8; see byte_values."""
    values = byte_values(lower, letters)[data]
    inside = values != 0
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    starts = np.flatnonzero(begins)
    firsts = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(np.zeros(0, np.uint64), starts, starts, firsts, data)
    stops = inside
    stops[:-1] &= ~inside[1:] | edge[1:n]
    ends = np.flatnonzero(stops) + 1
    place = np.arange(n, dtype=np.int64)
    place[starts[0] :] -= np.repeat(starts, np.diff(np.append(starts, n)))
    place[: starts[0]] = 0
    longest = int((ends - starts).max())
    table = powers(1 << max(6, (longest - 1).bit_length()))
    np.minimum(place, len(table) - 1, out=place)  # only white space lies beyond
    sums = np.add.reduceat(values * table[place], starts)
    return Words(mixed(sums + (ends - starts).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)), starts, ends, firsts, data)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive words; across texts too, which the caller leaves out."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    odd = random_u64(n, 11) | np.uint64(1)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        out += hashes[k : len(hashes) - n + 1 + k] * odd[k]
    return mixed(out)


def stretches(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of successive rows of a string column with no nulls."""
    texts = texts.cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(bounds, bounds[row] + STRETCH, "right")) - 1)
        yield row, stop, data[bounds[row] : bounds[stop]], bounds[row : stop + 1] - bounds[row]
        row = stop
