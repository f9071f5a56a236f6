"""Toxicity: a bidirectional gated recurrent network with attention over windows of words, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsluice.llm.arrays import Words, byte_values, mixed, powers, random_u64, stretches, words
from jobsluice.llm.common import dropped, read, stored, text_of
from jobsluice.llm.language import fold

#: Words of a window and from one window to the next.
WINDOW, STRIDE = 32, 16
#: Units of each direction, and numbers learnt for each word and each stretch of characters.
UNITS, LEARNT = 8, 4
#: Bound of the labelled sample that the network is fitted on, in documents. Their texts stay in Spark, whole.
SAMPLE_ROWS = 4000
#: Entries of the table of words and stretches of characters, which goes to every worker: the most telling so many.
MOST_ENTRIES = 1 << 17
#: Lengths in characters of the stretches that open and close a word.
OPENING, CLOSING = (3, 4, 5, 6, 8), (4,)
#: A word and its stretches; and its inputs: what each says beforehand, what is learnt of it, and whether it is unknown.
PARTS = 1 + len(OPENING) + len(CLOSING)
INPUTS = PARTS + 2 * LEARNT + 1
#: Documents that a table entry's prior counts for, and those it needs.
PRIOR, LEAST_SEEN = 4.0, 3
#: One document of the sample in so many is kept from training, to place the cut between the labels.
CALIBRATION = 5


class Model(NamedTuple):
    """Entries by hash (sorted), their prior log odds and learnt vectors, weights, the score of a text without words, and
    what is added to every logit."""

    hashes: np.ndarray
    odds: np.ndarray
    vectors: np.ndarray
    weights: dict[str, np.ndarray]
    empty: float
    shift: float


def _parts(found: Words, at: np.ndarray) -> np.ndarray:
    """Hashes of the words at ``at`` (rows) and of the characters that open and close them; 0 where a word is shorter.

    Characters are code points: a stretch ends where a byte begins the next one.
    """
    values, table = byte_values(True, True), powers(64)
    starts, ends = found.starts[at], found.ends[at]
    size, limit = ends - starts, len(found.data) - 1
    out = np.zeros((len(at), PARTS), np.uint64)
    out[:, 0] = mixed(found.hashes[at] + np.uint64(1))
    total, letters = np.zeros(len(at), np.uint64), np.zeros(len(at), np.int64)
    for j in range(4 * max(OPENING) + 1):
        byte = found.data[np.minimum(starts + j, limit)]
        begins = (j < size) & (byte & 0xC0 != 0x80)
        for k, length in enumerate(OPENING):
            whole = ((j == size) | begins) & (letters == length)
            out[whole, 1 + k] = mixed(total[whole] + np.uint64(2 + k))
        letters += begins
        total = np.where(j < size, total + values[byte] * table[j], total)
    total, letters = np.zeros(len(at), np.uint64), np.zeros(len(at), np.int64)
    for j in range(4 * max(CLOSING)):
        byte = found.data[np.maximum(ends - 1 - j, 0)]
        total = total + values[byte] * table[j]
        begins = (j < size) & (byte & 0xC0 != 0x80)
        letters += begins
        for k, length in enumerate(CLOSING):
            whole = begins & (letters == length)
            out[whole, 1 + len(OPENING) + k] = mixed(total[whole] + np.uint64(32 + k))
    return out


def _parts_of(found: Words) -> np.ndarray:
    """The parts of every word, each distinct word being taken apart once."""
    _, one, place = np.unique(found.hashes, return_index=True, return_inverse=True)
    return _parts(found, one)[place]


def _places(parts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where each part stands in the table; beyond its end if it does not."""
    if not len(hashes):
        return np.zeros(parts.shape, np.int64)
    at = np.minimum(np.searchsorted(hashes, parts), len(hashes) - 1)
    return np.where(hashes[at] == parts, at, len(hashes))


def _inputs(odds: np.ndarray, places: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inputs of words: the log odds of their parts [words, PARTS], the learnt vector of the word, the mean of those of its
    characters, and whether nothing is known of the word. ``vectors`` ends with a row of zeros for what is unknown."""
    out = np.empty((len(odds), INPUTS), np.float32)
    out[:, :PARTS] = odds
    out[:, PARTS : PARTS + LEARNT] = vectors[places[:, 0]]
    out[:, PARTS + LEARNT : -1] = vectors[places[:, 1:]].mean(axis=1)
    out[:, -1] = odds[:, 0] == 0
    return out


def _odds(seen: np.ndarray, bad: np.ndarray, rate: float) -> np.ndarray:
    """Shrunk log odds of entries that ``seen`` documents have, ``bad`` of them toxic; with a zero for what is unknown."""
    odds = np.log((bad + PRIOR * rate) / (seen - bad + PRIOR * (1 - rate))) - np.log(rate / (1 - rate))
    return np.append(np.where(seen >= LEAST_SEEN, odds, 0), 0).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def initial(seed: int = 1) -> dict[str, np.ndarray]:
    """Weights before training. Gates stand in the order update, reset, candidate; f and b are the directions."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
    w = {f"{name}{d}": draw(n, 3 * UNITS) for d in "fb" for name, n in (("x", INPUTS), ("h", UNITS))}
    w |= {f"c{d}": np.zeros(3 * UNITS, np.float32) for d in "fb"}
    return w | {"a": draw(2 * UNITS, UNITS), "v": draw(UNITS, 1), "o": draw(2 * UNITS, 1), "p": np.zeros(1, np.float32)}


def forward(w: dict[str, np.ndarray], gates: dict[str, np.ndarray], mask: np.ndarray, keep: bool = False):
    """Logits of windows. ``gates``: the inputs' share of the gates, [words, 3 * UNITS] looked up by ``mask`` rows.

    mask: [windows, steps] index of each step's row in gates, -1 beyond the window's end, where the state stays.
    """
    n, steps = mask.shape
    states = np.zeros((n, steps, 2 * UNITS), np.float32)
    saved = []
    for k, d in enumerate("fb"):
        h = np.zeros((n, UNITS), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            x = gates[d][mask[:, t]]
            live = (mask[:, t] >= 0)[:, None]
            r_h = h @ w[f"h{d}"]
            zr = _sigmoid(x[:, : 2 * UNITS] + r_h[:, : 2 * UNITS])
            z, r = zr[:, :UNITS], zr[:, UNITS:]
            c = np.tanh(x[:, 2 * UNITS :] + r * r_h[:, 2 * UNITS :])
            new = np.where(live, h + z * (c - h), h)
            if keep:
                saved.append((d, t, h, z, r, c, r_h[:, 2 * UNITS :], live))
            h = new
            states[:, t, k * UNITS : (k + 1) * UNITS] = h
    e = np.tanh(states @ w["a"])
    weight = (e @ w["v"])[:, :, 0]
    weight = np.where(mask >= 0, weight, -1e9)
    weight = np.exp(weight - weight.max(axis=1, keepdims=True))
    weight /= weight.sum(axis=1, keepdims=True)
    pooled = (weight[:, None, :] @ states)[:, 0]
    logit = (pooled @ w["o"])[:, 0] + w["p"][0]
    return (logit, states, e, weight, pooled, saved) if keep else logit


def gradient(w: dict[str, np.ndarray], inputs: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy of windows and its gradient, that of each window's inputs among it. inputs: [rows, INPUTS],
    looked up by mask."""
    gates = {d: inputs @ w[f"x{d}"] + w[f"c{d}"] for d in "fb"}
    logit, states, e, weight, pooled, saved = forward(w, gates, mask, keep=True)
    p = _sigmoid(logit)
    loss = float(-np.mean(label * np.log(p + 1e-7) + (1 - label) * np.log(1 - p + 1e-7)))
    g = {k: np.zeros_like(v) for k, v in w.items()}
    d_logit = ((p - label) / len(label)).astype(np.float32)[:, None]
    g["o"], g["p"] = pooled.T @ d_logit, d_logit.sum(axis=0)
    d_pooled = d_logit @ w["o"].T
    d_states = weight[:, :, None] * d_pooled[:, None, :]
    d_weight = (states @ d_pooled[:, :, None])[:, :, 0]
    d_weight = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
    d_e = d_weight[:, :, None] * w["v"][:, 0]
    d_e *= 1 - e * e
    g["v"] = np.einsum("nth,nt->h", e, d_weight)[:, None]
    g["a"] = np.einsum("nts,nth->sh", states, d_e)
    d_states += d_e @ w["a"].T
    g["inputs"] = np.zeros((*mask.shape, inputs.shape[1]), np.float32)
    back = {"f": np.zeros((len(label), UNITS), np.float32), "b": np.zeros((len(label), UNITS), np.float32)}
    for d, t, h, z, r, c, own, live in reversed(saved):
        k = "fb".index(d)
        total = back[d] + d_states[:, t, k * UNITS : (k + 1) * UNITS]
        d_new = np.where(live, total, 0)
        d_c = d_new * z * (1 - c * c)
        d_z = d_new * (c - h) * z * (1 - z)
        d_r = d_c * own * r * (1 - r)
        d_gate = np.concatenate([d_z, d_r, d_c], axis=1)
        d_rh = np.concatenate([d_z, d_r, d_c * r], axis=1)
        g[f"x{d}"] += inputs[mask[:, t]].T @ d_gate
        g["inputs"][:, t] += d_gate @ w[f"x{d}"].T
        g[f"c{d}"] += d_gate.sum(axis=0)
        g[f"h{d}"] += h.T @ d_rh
        back[d] = np.where(live, total * (1 - z), total) + d_rh @ w[f"h{d}"].T
    return loss, g


def train(odds: np.ndarray, places: np.ndarray, entries: int, masks: np.ndarray, labels: np.ndarray, steps: int = 1000, batch: int = 64, rate: float = 0.01, seed: int = 1) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Weights and learnt vectors fitted to labelled windows, in ``steps`` steps or a little more.

    Weights by Adam; the vectors of a batch's words and characters by steps that shrink with what a vector has moved.
    """
    w, rng = initial(seed), np.random.default_rng(seed)
    vectors, moved = np.zeros((entries + 1, LEARNT), np.float32), np.full((entries + 1, LEARNT), 1e-6, np.float32)
    epochs = -(-steps // -(-len(labels) // batch))
    m, v, step = {k: 0.0 * x for k, x in w.items()}, {k: 0.0 * x for k, x in w.items()}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(labels))
        for first in range(0, len(order), batch):
            rows = order[first : first + batch]
            live = masks[rows] >= 0
            words = masks[rows][live]
            mask = np.full(live.shape, -1, np.int64)
            mask[live] = np.arange(len(words))
            _, g = gradient(w, _inputs(odds[words], places[words], vectors), mask, labels[rows])
            d_words, step = g.pop("inputs")[live], step + 1
            pace = rate * (1 - epoch / epochs)
            for k in w:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                w[k] = (w[k] - pace * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            d_vectors = np.concatenate([d_words[:, None, PARTS : PARTS + LEARNT], np.repeat(d_words[:, None, PARTS + LEARNT : -1], PARTS - 1, axis=1) / (PARTS - 1)], axis=1)
            used, place = np.unique(places[words], return_inverse=True)
            total = np.zeros((len(used), LEARNT), np.float32)
            np.add.at(total, place.ravel(), d_vectors.reshape(-1, LEARNT))
            known = used < entries
            used, total = used[known], total[known]
            moved[used] += total**2
            vectors[used] -= pace * total / np.sqrt(moved[used])
    return w, vectors


def _windows(firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All overlapping windows of texts whose words begin at ``firsts``: the text of each and its words, -1 beyond."""
    size = np.diff(firsts)
    count = np.where(size > 0, np.maximum(1, -(-(size - WINDOW) // STRIDE) + 1), 0)
    text = np.repeat(np.arange(len(size)), count)
    place = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    at = (firsts[text] + place * STRIDE)[:, None] + np.arange(WINDOW)
    return text, np.where(at < firsts[text + 1][:, None], at, -1)


def _lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts.cast(pa.large_string()))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, Words]]:
    """(batch, first row, words) of successive stretches of texts, the second column of each batch."""
    for batch in batches:
        for first, stop, data, offsets in stretches(_lowered(batch.column(1))):
            yield batch.slice(first, stop - first), first, words(data, offsets, letters=True)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of documents (id, text, toxic, side): hash of each part, and the documents and toxic ones of both sides that have it."""
    for batch, _, found in _texts(batches):
        parts = _parts_of(found)
        mine = [np.unique(parts[a:b]) for a, b in zip(found.firsts[:-1], found.firsts[1:])]
        label, side = (np.repeat(batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64), [len(x) for x in mine]) for k in (2, 3))
        hashes, place = np.unique(np.concatenate([*mine, np.zeros(0, np.uint64)]), return_inverse=True)
        counts = [np.bincount(place, x, len(hashes)).astype(np.int64) for x in (1 - side, (1 - side) * label, side, side * label)]
        keep = hashes != 0
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (hashes.view(np.int64), *counts)], ["hash", "seen0", "bad0", "seen1", "bad1"])


def _loudest(hashes: np.ndarray, tables: tuple[np.ndarray, np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of documents (id, text, toxic, side) the windows to learn from, as the parts of their words: those that the other
    side's statistics find most toxic, in toxic texts the one, in others two."""
    for batch, _, found in _texts(batches):
        parts = _parts_of(found)
        places = _places(parts, hashes)
        toxic, side = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (2, 3))
        rows, out = [], []
        for i, (a, b) in enumerate(zip(found.firsts[:-1], found.firsts[1:])):
            if a == b:
                continue
            odds = tables[1 - side[i]][places[a:b]]
            _, mask = _windows(np.array([0, b - a]))
            loudness = odds.max(axis=1) + 0.25 * odds.mean(axis=1)
            for k in np.argsort(-np.where(mask >= 0, loudness[mask], -9).max(axis=1), kind="stable")[: 1 if toxic[i] else 2]:
                rows.append(i)
                out.append(parts[a:b][mask[k][mask[k] >= 0]].tobytes())
        picked = batch.take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([picked.column(0), picked.column(2), picked.column(3), pa.array(out, pa.binary())], ["id", "toxic", "side", "parts"])


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from a bounded sample of labelled rows: SAMPLE_ROWS ids of ``labels`` in the order of their hash.

    Their whole texts stay in Spark. The driver gets the table of words and stretches of characters, MOST_ENTRIES at
    most, and one or two windows of each document. Statistics of one half of the documents are what is known beforehand
    of the other half's windows, so that no text tells its own label; the finished model has those of all. Vectors of
    words and characters are learnt with the network. What is added to the logits makes 0.5 the best cut between the
    documents that took no part in training.

    An id labelled more than once is toxic if any label says so, of several texts of an id the first is read; null labels
    and texts count for nothing. Without labels of both kinds every score is the same, low or high.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).filter("id is not null and toxic is not null")
    chosen = known.groupBy("id").agg((F.max("toxic") > 0).alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
    sample = stored(rows.select("id", "text", "toxic", (F.pmod(F.xxhash64("id", F.lit("half")), F.lit(2)) == 1).alias("side")), "sample")
    total, bad = sample.agg(F.count(F.lit(1)), F.coalesce(F.count_if("toxic"), F.lit(0))).first()
    rate = bad / total if total else 0.0
    if not 0 < bad < total:
        none = np.zeros(0, np.uint64)
        return Model(none, np.zeros(1, np.float32), np.zeros((1, LEARNT), np.float32), initial(), rate, -20.0 if rate < 0.5 else 20.0)
    counts = sample.mapInArrow(_counted, "hash long, seen0 long, bad0 long, seen1 long, bad1 long").groupBy("hash").agg(*[F.sum(c).alias(c) for c in ("seen0", "bad0", "seen1", "bad1")])
    seen, toxic = F.col("seen0") + F.col("seen1"), F.col("bad0") + F.col("bad1")
    weight = F.abs(F.log((toxic + PRIOR * rate) / (seen - toxic + PRIOR * (1 - rate))) - F.log(F.lit(rate / (1 - rate)))) * F.sqrt(seen)
    entries = counts.filter(seen >= LEAST_SEEN).withColumn("weight", weight).filter("weight >= 0.5").orderBy(F.desc("weight"), "hash").limit(MOST_ENTRIES).drop("weight").toPandas()
    order = np.argsort(entries["hash"].to_numpy(np.int64).view(np.uint64))
    hashes = entries["hash"].to_numpy(np.int64).view(np.uint64)[order]
    n0, b0, n1, b1 = (entries[c].to_numpy(np.int64)[order] for c in ("seen0", "bad0", "seen1", "bad1"))
    halves = (_odds(n0, b0, rate), _odds(n1, b1, rate))
    sent = docs.sparkSession.sparkContext.broadcast((hashes, halves))
    id_type = sample.schema["id"].dataType.simpleString()
    windows = sample.mapInArrow(lambda batches: _loudest(*sent.value, batches), f"id {id_type}, toxic boolean, side boolean, parts binary").collect()
    dropped(sample)
    return _fit(sorted(windows, key=lambda r: (r["id"], r["parts"])), hashes, halves, _odds(n0 + n1, b0 + b1, rate), rate)


def _fit(windows: list, hashes: np.ndarray, halves: tuple[np.ndarray, np.ndarray], odds: np.ndarray, rate: float) -> Model:
    """The model of windows (id, toxic, side, parts) sorted by document."""
    parts = [np.frombuffer(r["parts"], np.uint64).reshape(-1, PARTS) for r in windows]
    places = [_places(p, hashes) for p in parts]
    beforehand = np.concatenate([halves[1 - r["side"]][p] for r, p in zip(windows, places)])
    places = np.concatenate(places)
    masks = np.full((len(windows), WINDOW), -1, np.int64)
    ends = np.cumsum([len(p) for p in parts])
    for mask, p, end in zip(masks, parts, ends):
        mask[: len(p)] = np.arange(end - len(p), end)
    labels = np.array([r["toxic"] for r in windows], np.float32)
    _, owner = np.unique(np.array([str(r["id"]) for r in windows]), return_inverse=True)
    apart = random_u64(owner.max() + 1, 5) % np.uint64(CALIBRATION) == 0  # of no pattern that ids or labels could share
    trained = ~apart[owner]
    w, vectors = train(beforehand, places, len(hashes), masks[trained], labels[trained])
    x = _inputs(beforehand, places, vectors)
    gates = {d: x @ w[f"x{d}"] + w[f"c{d}"] for d in "fb"}
    best, toxic = np.full(len(apart), -np.inf), np.zeros(len(apart), np.int64)
    np.maximum.at(best, owner, forward(w, gates, masks))
    np.maximum.at(toxic, owner, labels.astype(np.int64))
    judges = apart if 0 < toxic[apart].sum() < apart.sum() else np.ones(len(apart), bool)
    best, toxic = best[judges], toxic[judges]
    order = np.argsort(-best, kind="stable")
    hits = np.cumsum(toxic[order])
    right = hits - (np.arange(len(order)) + 1 - hits)  # documents won by a cut after each
    cut = int(right.argmax())
    shift = -0.5 * (best[order[cut]] + max(best[order[min(cut + 1, len(order) - 1)]], best[order[cut]] - 2))
    return Model(hashes, odds, vectors, w, rate, float(shift))


def _scored(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    w = model.weights
    for batch, _, found in _texts(batches):
        logit = np.full(batch.num_rows, -np.inf)
        text, mask = _windows(found.firsts)
        if len(text):
            _, one, place = np.unique(found.hashes, return_index=True, return_inverse=True)
            places = _places(_parts(found, one), model.hashes)
            x = _inputs(model.odds[places], places, model.vectors)
            gates = {d: x @ w[f"x{d}"] + w[f"c{d}"] for d in "fb"}
            place = np.append(place, -1)
            for k in range(0, len(text), 4096):
                np.maximum.at(logit, text[k : k + 4096], forward(w, gates, place[mask[k : k + 4096]]))
        scores = np.where(np.diff(found.firsts) > 0, _sigmoid(logit + model.shift), model.empty)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["id", "score"])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of each row of ``docs``: the highest of all overlapping windows of its whole text.

    Texts without words, null and empty ones too, have the share of toxic texts in the sample. Rows pass one by one:
    repeats, null ids and empty tables are as they are; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(lambda batches: _scored(sent.value, batches), f"id {rows.schema['id'].dataType.simpleString()}, score double")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = learn(docs, labels.filter(fold("doc_id", 5) != 0))
    rows = score(docs, model)
    return rows.select(F.col("id").alias("doc_id"), F.coalesce(fold("id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
