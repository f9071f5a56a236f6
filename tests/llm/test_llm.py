import collections
import hashlib
import json
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import regex
from oracle import connect, rows_of_duckdb, rows_of_spark
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jobsluice.llm import arrays, bpe, chat, common, decontaminate, exact_dedup, jaccard_join, language, secrets, substring_dedup, toxicity, url_filter
from jobsluice.llm.queries import LLM_ORACLES, LLM_QUERIES

FOLDER = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_sql(spark, name):
    assert rows_of_spark(LLM_QUERIES[name](spark, FOLDER)) == rows_of_duckdb(connect(FOLDER), LLM_ORACLES[name])


# Words and hashes.


def test_words_are_those_of_split():
    texts = ["", " a  b\x0bc ", "é\xa0x\x1cy", "one", "A b", "x" * 3000]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.append(0, np.cumsum([len(t.encode()) for t in texts]))
    found = arrays.words(data, offsets)
    got = [[bytes(data[s:e]) for s, e in zip(found.starts[a:b], found.ends[a:b])] for a, b in zip(found.firsts, found.firsts[1:])]
    assert got == [t.encode().split() for t in texts]
    assert arrays.words(np.frombuffer(b"Ab aB", np.uint8), np.array([0, 5]), lower=True).hashes.tolist()[0] == arrays.words(np.frombuffer(b"ab", np.uint8), np.array([0, 2])).hashes[0]


# Toxicity.


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, toxicity.INPUTS)).astype(np.float32)
    mask = rng.integers(0, 40, (5, toxicity.WINDOW))
    mask[0, 11:] = -1
    label = rng.integers(0, 2, 5).astype(np.float32)
    w = {k: v.astype(np.float64) for k, v in toxicity.initial().items()}
    _, g = toxicity.gradient(w, x, mask, label)
    for k in w:
        at = tuple(rng.integers(0, s) for s in w[k].shape)
        losses = []
        for step in (1e-3, -1e-3):
            moved = {n: v.copy() for n, v in w.items()}
            moved[k][at] += step
            losses.append(toxicity.gradient(moved, x, mask, label)[0])
        assert g[k][at] == pytest.approx((losses[0] - losses[1]) / 2e-3, rel=0.02, abs=1e-5)


def test_windows_overlap_and_cover_all():
    text, mask = toxicity._windows(np.array([0, 0, 10, 110]))
    assert set(text.tolist()) == {1, 2}
    assert set(mask[text == 2].ravel().tolist()) == set(range(10, 110)) | ({-1} if (mask[text == 2] < 0).any() else set())
    starts = mask[text == 2][:, 0]
    assert (np.diff(starts) == toxicity.STRIDE).all() and toxicity.STRIDE < toxicity.WINDOW


def learnt_from(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    return toxicity.learn(docs, spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int"))


def test_stretches_are_of_characters():
    texts = ["éàüß", "éàüßx", "日本語文字列", "ab", "abcdefghij"]
    data = np.frombuffer(" ".join(texts).encode(), np.uint8)
    parts = toxicity._parts_of(arrays.words(data, np.array([0, len(data)]), letters=True))
    sizes = [len(t) for t in texts]
    for k, length in enumerate(toxicity.OPENING):
        assert [bool(x) for x in parts[:, 1 + k]] == [n >= length for n in sizes]
    assert [bool(x) for x in parts[:, -1]] == [n >= 4 for n in sizes]
    assert (parts[0, 1:3] == parts[1, 1:3]).all() and parts[0, 0] != parts[1, 0] and parts[0, -1] != parts[1, -1]


def test_window_scores_are_those_of_a_plain_loop(spark):
    """A document's logit is the highest of its windows, each gone through one step at a time."""
    model = learnt_from(spark, toy_rows())
    assert np.abs(model.vectors[:-1]).max() > 0 and not model.vectors[-1].any()
    w, sigmoid = model.weights, lambda x: 1 / (1 + np.exp(-np.float64(x)))
    for text, _ in toy_rows(420)[400:]:
        data = np.frombuffer(text.lower().encode(), np.uint8)
        places = toxicity._places(toxicity._parts_of(arrays.words(data, np.array([0, len(data)]), letters=True)), model.hashes)
        x = toxicity._inputs(model.odds[places], places, model.vectors)
        logits = []
        for start in range(0, max(1, len(x) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE):
            window, states = x[start : start + toxicity.WINDOW], {}
            for d in "fb":
                h, seen = np.zeros(toxicity.UNITS), []
                for row in window if d == "f" else window[::-1]:
                    a, b = row @ w[f"x{d}"] + w[f"c{d}"], h @ w[f"h{d}"]
                    u = toxicity.UNITS
                    z, r = sigmoid(a[:u] + b[:u]), sigmoid(a[u : 2 * u] + b[u : 2 * u])
                    h = h + z * (np.tanh(a[2 * u :] + r * b[2 * u :]) - h)
                    seen.append(h)
                states[d] = seen if d == "f" else seen[::-1]
            both = np.concatenate([np.array(states["f"]), np.array(states["b"])], axis=1)
            weight = np.exp((np.tanh(both @ w["a"]) @ w["v"])[:, 0])
            logits.append(float((weight / weight.sum()) @ both @ w["o"][:, 0] + w["p"][0]))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        assert toxicity.score(docs, model).first()["score"] == pytest.approx(sigmoid(max(logits) + model.shift), abs=1e-3)


def test_toxicity_query_learns_from_its_fold_alone(spark, tmp_path):
    """Labels of held-out rows may say anything, and are not needed to find them."""
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    rows = toy_rows(900)
    long = [(900, ("plain words here " * 3000) + "zonked", 1), (901, "plain words here " * 3000, 0)]
    rows = [(i, t, y) for i, (t, y) in enumerate(rows)] + long + [(902, None, 0), (903, "", 0)]
    scores = []
    for wrong in (0, 1):
        folder = f"file://{tmp_path}/{wrong}"
        spark.createDataFrame([(i, t, "xx", "s") for i, t, _ in rows], "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(i, 0, (1 - y if wrong and fold(i) == 0 else y)) for i, _, y in rows], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        scores.append({r["doc_id"]: (r["held_out"], r["score"], r["predicted"]) for r in LLM_QUERIES["op1_toxicity"](spark, folder).collect()})
    assert scores[0] == scores[1] and len(scores[0]) == len(rows)
    assert all(held == (fold(i) == 0) and 0 <= score <= 1 and predicted == int(score >= 0.5) for i, (held, score, predicted) in scores[0].items())
    assert np.mean([scores[0][i][2] == y for i, _, y in rows if fold(i) == 0]) > 0.95
    assert scores[0][900][2] == 1 and scores[0][901][2] == 0


def toy_rows(n=400):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(60)]
    out = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        if i % 4 == 0:
            text[rng.randrange(len(text))] = rng.choice(["Zonker", "zonkish!", "zonked"])
        out.append((" ".join(text), int(i % 4 == 0)))
    return out


def test_toxicity_learns_words_and_openings(spark, awkward, empty):
    model = learnt_from(spark, toy_rows())
    plain = toy_rows(460)[401][0]
    held = toy_rows(460)[400:] + [((plain + " ") * 40 + "zonked " + (plain + " ") * 40, 1), ((plain + " ") * 80, 0)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(held)], "doc_id long, text string")
    got = {r["id"]: r["score"] >= 0.5 for r in toxicity.score(docs, model).collect()}
    assert np.mean([got[i] == bool(y) for i, (_, y) in enumerate(held)]) > 0.95
    assert got[len(held) - 2] and not got[len(held) - 1]  # one word among thousands
    rows = toxicity.score(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(empty, model).count() == 0


def test_toxicity_without_labels(spark, awkward):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(r["score"] < 0.5 for r in toxicity.score(awkward, toxicity.learn(awkward, labels)).collect())


# Chat.


def test_events_are_folded(spark):
    events = [
        (1, 1, 0, "message", "user", "hi"), (1, 2, 1, "message", "assistant", "He"), (1, 3, 1, "delta", None, "llo"), (1, 4, 1, "regenerate", None, "G"), (1, 5, 1, "delta", None, "ood"),
        (1, 6, 0, "edit", None, "hi there"), (1, 7, 2, "message", "user", "bye"), (1, 8, 2, "delete", None, None), (2, 1, 0, None, None, None), (None, 5, 0, "message", "user", "x"),
    ]
    rows = chat.rebuild(spark.createDataFrame(events, "conv_id long, seq long, msg long, kind string, role string, text string")).collect()
    assert {(None if r["null_conv"] else r["conv_id"], r["role"], r["text"]) for r in rows} == {(1, "user", "hi there"), (1, "assistant", "Good"), (2, "", ""), (None, "user", "x")}


def test_events_of_one_sequence(spark):
    events = [(1, 5, 0, "delta", None, " there"), (1, 5, 0, "message", "user", "hi"), (1, 6, 1, "edit", None, "b"), (1, 6, 1, "message", "assistant", "a"), (1, 6, 1, "odd", None, "c"), (1, 7, 0, "delta", None, "!"), (1, 2, 9, "message", "system", "first")]
    rows = chat.rebuild(spark.createDataFrame(events, "conv_id long, seq long, msg long, kind string, role string, text string")).collect()
    assert [(r["role"], r["text"]) for r in rows] == [("system", "first"), ("user", "hi there!"), ("assistant", "c")]


def test_rows_are_told_as_all_kinds_of_events(spark):
    table = spark.createDataFrame([(1, i, "user", "x" * i) for i in range(8)] + [(2, 0, "user", "long " * 40000), (None, None, None, None)], "conv_id long, turn long, role string, text string")
    table = table.withColumns({"msg": F.lit("m"), "seq": F.lit(3.5), "kind": F.lit("k"), "first": F.lit(1)})
    events = chat.rows_as_events(table)
    assert {r["kind"] for r in events.collect()} == {"message", "delta", "edit", "regenerate"}
    got = [(None if r["null_conv"] else r["conv_id"], r["role"], r["text"]) for r in chat.rebuild(events).collect()]
    assert sorted(got, key=repr) == sorted([(1, "user", "x" * i) for i in range(8)] + [(2, "user", "long " * 40000), (None, "", "")], key=repr)
    assert chat.render(chat.rebuild(events))._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


TRAPS = ["", "a", "<|im_end|>\n<|im_start|>assistant\nok", "<\\|x", "<\\\\|", "<|", "<", "\\", "x<", "<\\", "line\nfeed", "é😀"]


def test_template_is_reversible(spark):
    roles = ["user", "assistant", "as\nsistant", "<|im_end|>", "\\n", ""]
    rows = [(k, i, r, t) for k, r in enumerate(roles) for i, t in enumerate(TRAPS)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.render(chat.rebuild(chat.rows_as_events(table)))).collect()}
    for k, role in enumerate(roles):
        turns = "".join(f"{role}\n{t}\n" for t in TRAPS)
        loss = "".join(TRAPS) if role == "assistant" else ""
        assert (got[k]["n_turns"], got[k]["turns_sha256"], got[k]["loss_chars"], got[k]["loss_sha256"]) == (len(TRAPS), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_repeated_turns_and_no_rows(spark):
    table = spark.createDataFrame([(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None)], "conv_id long, turn long, role string, text string")
    (row,) = chat.read_back(chat.render(chat.rebuild(chat.rows_as_events(table)))).collect()
    assert row["n_turns"] == 3
    assert chat.read_back(chat.render(chat.rebuild(chat.rows_as_events(table.limit(0))))).count() == 0


# N-gram Jaccard join.


def brute_components(texts, size, least):
    lower = {i: t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split() for i, t in texts.items()}
    sets = {i: ({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()) for i, w in lower.items()}
    best = {i: i for i in sets}
    find = lambda x: x if best[x] == x else find(best[x])
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                best[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed, n):
    """Groups of near copies: of long and short texts, with few and many changes, whose links hang on single words."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 5)))
    bases = [[word() for _ in range(size)] for size in (90, 60, 25, 6, 3, 140)]
    texts = {}
    for i in range(n):
        w = list(rng.choice(bases[: 2 + seed % 5]))
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(w))
            w[at : at + 1] = rng.choice([[word()], [], [w[at], word()]])
            w = w or ["a"]
        texts[i * 7 % 1009] = rng.choice([" ", "  "]).join(w) if i % 11 else " ".join(word() for _ in range(30))
    return texts


@pytest.mark.parametrize(("seed", "size", "least"), [(1, 4, 85), (2, 5, 80), (3, 2, 60)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, seed, size, least):
    monkeypatch.setattr(jaccard_join, "LONG", 12)
    texts = near_copies(seed, 260)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(docs, jaccard_join.Rule(size, least)).collect()}
    assert got == brute_components(texts, size, least)


def test_no_link_between_leaders_is_missed(spark):
    rule = jaccard_join.Rule(3, 80)
    texts = near_copies(4, 150)
    docs = spark.createDataFrame(list(texts.items()), "id long, text string")
    sets = docs.mapInArrow(jaccard_join._whole(3), "id long, n int, key1 long, key2 long, grams binary").filter("n > 0").select("id", "n", "grams")
    lists = sets.mapInArrow(jaccard_join._explode_prefixes(rule), "gram long, id long, n int")
    apart = docs.select("id", F.col("id").alias("leader"))
    pairs = jaccard_join._pairs_over_leaders(lists, apart, docs.select("id", F.col("id").alias("component")).limit(0), rule)
    got = {(r["a"], r["b"]) for r in jaccard_join.verified(pairs, sets, rule).collect()}
    grams = {r["id"]: set(np.frombuffer(r["grams"], np.uint64).tolist()) for r in sets.collect()}
    want = {(a, b) for a in grams for b in grams if b < a and 100 * len(grams[a] & grams[b]) >= 80 * len(grams[a] | grams[b])}
    assert got == want and len(want) > 100


@pytest.mark.parametrize("n", [0, 1, 70, 400, 500])
def test_first_by_digest_is_the_head_of_the_order(spark, n):
    rows = spark.range(400).select((F.col("id") % 300).alias("id")).withColumn("h", F.sha2((F.col("id") % 90).cast("string"), 256))
    assert sorted(secrets.first_by_digest(rows, n).collect()) == sorted(rows.orderBy("h", "id").limit(n).collect())


def test_jaccard_of_the_awkward(spark, awkward, empty):
    rows = jaccard_join.near_duplicates(awkward, jaccard_join.Rule(4, 85)).collect()
    assert len(rows) == awkward.count()
    got = {r["id"]: r for r in rows}
    assert got[1]["n_shingles"] == got[3]["n_shingles"] == 0 and (got[1]["component_id"], got[3]["component_id"]) == (1, 3)
    assert got[5]["component_id"] is None and got[8]["component_id"] == 7  # the null id comes first
    kept = jaccard_join.keep_one_of_each(awkward, jaccard_join.Rule(4, 85))
    assert kept.columns == awkward.columns and 8 not in {r["doc_id"] for r in kept.collect()}
    assert jaccard_join.near_duplicates(empty).count() == 0


# URL filter.


def test_urls(spark):
    urls = ["http://A.example.org/es/1?x", "http://example.org/en/12#t", "https://x.org", "https://com/fr/x", "http://b.com/de/", "notorg/", None, "", "x://", "http://org/a\nb", "https://xorg/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(None, "http://b.com/q", None)], "page_id long, url string, host string")
    outcomes = spark.createDataFrame([("bad.net", 0)] * 40 + [("good.net", 1)] * 40, "host string, good int")
    got = {r["id"]: r for r in url_filter.filter_urls(pages, outcomes, url_filter.RULES).collect()}
    assert len(got) == 12
    assert [got[i]["rule"] for i in range(11)] == ["example.org/es/", "example.org/en/1", None, "com/fr/", "com/de/", None, None, None, None, "org/", None]
    assert [(got[i]["host"], got[i]["path"]) for i in (0, 2, 5, 6, 8, 9)] == [("a.example.org", "/es/1"), ("x.org", ""), ("", ""), ("", ""), ("", ""), ("org", "/a\nb")]
    assert url_filter.filter_urls(pages.limit(0), outcomes, url_filter.RULES).count() == 0


def test_reputation_shrinks(spark):
    hosts = [("a.bad.net", 0)] * 60 + [("b.bad.net", None)] + [("c.bad.net", 1)] + [(f"h{i}.good.net", 1) for i in range(60)] + [("d.good.net", 0)]
    got = {r["host"]: r for r in url_filter.host_reputation(spark.createDataFrame(hosts, "host string, good int")).collect()}
    assert got["a.bad.net"]["upper"] < got["a.bad.net"]["least"] == got["d.good.net"]["least"] < got["d.good.net"]["upper"]
    assert got["a.bad.net"]["mean"] < got["b.bad.net"]["mean"] < got["d.good.net"]["mean"] < got["h1.good.net"]["mean"]


def test_hosts_that_differ_are_told_apart(spark, tmp_path):
    """The query over its tables: good and bad hosts, a new one of each domain, long urls, repeated rows, null labels."""
    shares = {"a.bad.net": 4, "b.bad.net": 4, "www.good.net": 18, "x.good.net": 19, "mixed.info": 15}
    pages, labels, n = [], [], 0
    for host, good in shares.items():
        for i in range(200):
            pages.append((n, f"http://{host}/en/{n}?q=1", ""))
            labels.append((n, int(i % 20 < good), 0 if n % 50 else None))
            n += 1
    pages += [(n, "http://new.bad.net/x", ""), (n + 1, "http://new.good.net/x", ""), (n + 2, "http://b.bad.net/" + "p" * 50000, None), (5, "http://a.bad.net/en/5?q=1", ""), (None, None, None), (n + 3, "http://sub.a.bad.net/it/1", "")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"file://{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    rows = LLM_QUERIES["op4_url_filter"](spark, f"file://{tmp_path}").collect()
    assert len(rows) == len(pages)
    by_host = {h: {r["verdict"] for r in rows if r["host"] == h} for h in {r["host"] for r in rows}}
    for host in ("a.bad.net", "b.bad.net", "new.bad.net", "sub.a.bad.net"):
        assert by_host[host] == {"block"}, host
    for host in ("www.good.net", "x.good.net", "new.good.net", "mixed.info", ""):
        assert by_host[host] == {"allow"}, host
    con = duckdb.connect()
    for name in ("pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.execute(f"SELECT page_id, host, verdict FROM ({LLM_ORACLES['op4_url_filter']}) WHERE page_id IS NOT NULL AND page_id <> 5").fetchall()
    assert sorted(want) == sorted((r["page_id"], r["host"], r["verdict"]) for r in rows if r["page_id"] not in (None, 5))


# BPE.


@pytest.fixture(scope="module")
def vocabulary():
    path = bpe.default_vocabulary()
    with open(path, "rb") as file:
        return Tokenizer.from_file(path), bpe.Bpe(file.read())


def test_ids_are_those_of_the_library(vocabulary):
    library, own = vocabulary
    rng = random.Random(5)
    letters = "ab 's't\n\t\r\x0b\x0c\x1c\x85\xa0\u2003\u3000\u200b\ufeffßéñ漢字😀٣½1 2''.,!-_́\x00\x7f"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["x<|endoftext|>  y", "<|endoftext|><|endoftext|> ", "ab" * 3000, " " * 5000, "aAbB!" * 500, "a  b\n c", "é" * 400]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        packed = own.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == want.ids, repr(text)
        assert own.decode(packed) == library.decode(want.ids, skip_special_tokens=False)


def test_letters_are_those_of_the_library(vocabulary):
    """All code points about the edges of what newer tables call letters, beside letters, numbers, signs and contractions."""
    library, own = vocabulary
    near = sorted({int(x, 16) + d for r in bpe.LATE.split() for x in r.split("-") for d in (-1, 0, 1)} | set(range(0x250, 0x3000, 7)) | set(range(0x323A0, 0x323C0)))
    pool = ["a", "1", " ", "'s", "!", "é", "  "] + [chr(c) for c in near]
    rng = random.Random(7)
    texts = [p + chr(c) + q for c in near for p, q in (("a", "b"), (" 1", "'s"), ("!", "?"))]
    texts += ["".join(rng.choice(pool[: 7 if rng.random() < 0.4 else None]) for _ in range(rng.randrange(1, 12))) for _ in range(3000)]
    for text in texts:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, ascii(text)


def test_long_words_merge_alike(vocabulary):
    own = vocabulary[1]
    for word in ("abcdeßzüghlien" * 40, "aaaaaaaab" * 90, "x"):
        ids = own.first[np.frombuffer(word.encode(), np.uint8)].tolist()
        assert own.merge_short(list(ids)) == own.merge_long(list(ids))


def test_new_words_are_merged_together(vocabulary, monkeypatch):
    library, own = vocabulary
    rng = random.Random(11)
    letters = ["aeinorst"] * 3 + ["aeiouéüß", "漢字かな"]
    words = ["".join(rng.choice(letters[k % 5]) for _ in range(rng.choice((3, 7, 12, 20, 40, 70)))) for k in range(4000)]
    words += [c * n for c in "aé漢" for n in (1, 2, 8, 9, 255, 256, 257, 300)] + ["ab" * 63, "aab" * 85]
    text = " ".join(words)
    own.known.clear()
    own.stretches.clear()
    alone = []
    monkeypatch.setattr(own, "merge_short", lambda ids, merge=own.merge_short: alone.append(len(ids)) or merge(ids))
    assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(alone) < 3 * bpe.TOGETHER


@pytest.mark.parametrize("held", [3, 200, 100_000])
def test_texts_are_encoded_together(held, vocabulary, monkeypatch):
    """What one text needs stays at hand while others push it out of what is remembered."""
    library, own = vocabulary
    monkeypatch.setattr(bpe, "REMEMBERED", held)
    monkeypatch.setattr(bpe, "STRETCH", 2000)
    monkeypatch.setattr(bpe, "KEYS", 70)
    monkeypatch.setattr(bpe, "TOGETHER", 2)
    own.known.clear()
    own.stretches.clear()
    rng = random.Random(held)
    pool = ["the", "then", "of", "x" * 300, "don't", "1a", "ß漢", "\u0558", "a\u1c89b", "\n", "\x1c", "\x85", "\u3000", "  ", "<|endoftext|>", "!?", "", "aba" * 20]
    texts = [" ".join(rng.choice(pool) + rng.choice(("", "", "ab", "é", "\n", "'s")) for _ in range(rng.randrange(60))) + rng.choice(("", " ", "\n", "\t", " \n")) for _ in range(400)]
    texts += ["", " ", "\n", " \n", "a ", " a", "a\n b", "y" * 5000, "z " * 3000]
    got = [np.frombuffer(x, "<u4").tolist() for x in own.encode_all(texts)]
    for text, ids, want in zip(texts, got, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids == want.ids, ascii(text)
    assert max(len(own.known), len(own.stretches)) <= held and list(own.encode_all([])) == []


def test_vocabularies_of_few_merges_and_bytes():
    bytes_of = {b: c for c, b in bpe.byte_letters().items()}
    vocab = {bytes_of[b]: i for i, b in enumerate(range(0x20, 0x7F))}
    words = [f"{a}{b}{c}" for a in "abc" for b in "abc" for c in "abc"]
    file = lambda merges, more=(): json.dumps({"model": {"vocab": vocab | {t: len(vocab) + i for i, t in enumerate(more)}, "merges": merges}}).encode()
    plain, own = bpe.Bpe(file([])), bpe.Bpe(file(["a b"], ["ab"]))
    assert [len(plain.encode(w)) // 4 for w in words] == [len(x) // 4 for x in plain.encode_all(words)] == [3] * 27
    assert [len(x) // 4 for x in own.encode_all(words)] == [3 - ("ab" in w) for w in words]
    for text in ("é", " ".join(w + "é" for w in words)):
        with pytest.raises((ValueError, OverflowError)):
            own.encode(text)


def test_bpe_of_the_awkward(spark, awkward, empty, vocabulary):
    rows = bpe.token_digests(awkward, bpe.default_vocabulary()).collect()
    texts = collections.defaultdict(set)
    for r in awkward.collect():
        texts[r["doc_id"]].add(r["text"] or "")
    for r in rows:
        assert r["decoded_sha256"] in {hashlib.sha256(t.encode()).hexdigest() for t in texts[r["doc_id"]]}
        assert r["n_tokens"] in {len(vocabulary[0].encode(t, add_special_tokens=False).ids) for t in texts[r["doc_id"]]}
    encoded = bpe.encode(awkward, bpe.default_vocabulary())
    assert bpe.decode(encoded, bpe.default_vocabulary()).count() == len(rows) == awkward.count()
    assert bpe.token_digests(empty, bpe.default_vocabulary()).count() == 0


# Substring deduplication.


def brute_cut(texts, k):
    first, out = {}, {}
    for i in sorted(texts):
        w = texts[i].encode().split()
        keep = [True] * len(w)
        for s in range(len(w) - k + 1):
            if first.setdefault(tuple(w[s : s + k]), (i, s)) != (i, s):
                keep[s : s + k] = [False] * k
        out[i] = (len(w), len(w) - sum(keep), b" ".join(x for x, y in zip(w, keep) if y).decode())
    return out


@pytest.mark.parametrize(("k", "hot", "most"), [(20, 1000, 20000), (6, 3, 4)])
def test_cuts_are_those_of_all_windows(spark, monkeypatch, k, hot, most):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    monkeypatch.setattr(substring_dedup, "MOST_MET", most)
    monkeypatch.setattr(common, "HOT_KEYS", 50)
    rng = random.Random(k)
    words = [f"w{i}" for i in range(40)]
    passages = [[rng.choice(words) for _ in range(rng.randint(k - 2, 3 * k))] for _ in range(6)]
    texts = {}
    for i in range(120):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += rng.choice(passages) if rng.random() < 0.6 else [rng.choice(words) for _ in range(rng.randint(1, 15))]
        texts[i * 37 % 1009] = " ".join(w) if i % 9 else "one two " * 60
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring_dedup.cut_repeats(docs, k).collect()}
    assert got == brute_cut(texts, k)
    sources = {i: t.split() for i, t in texts.items()}
    for r in substring_dedup.repeated_spans(docs, k).collect():  # each span stands at its source, word by word
        assert (r["from_id"], r["from_start"]) < (r["id"], r["start"])
        assert sources[r["id"]][r["start"] : r["start"] + r["n_words"]] == sources[r["from_id"]][r["from_start"] : r["from_start"] + r["n_words"]]


def test_cuts_come_from_the_chains(spark, monkeypatch):
    """B repeats A's end and then C's beginning: two paths, one chain. With chains mixed up, nothing right is cut."""
    rng = random.Random(5)
    a, c = ([f"w{rng.randint(0, 9999)}" for _ in range(60)] for _ in range(2))
    texts = {1: " ".join(a), 2: " ".join(a[-19:] + c), 3: " ".join(["x"] + a[10:] + c[:50] + ["y"]), 4: " ".join(["z"] + c[20:40])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    cut = lambda: {r["id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring_dedup.cut_repeats(docs).collect()}
    assert cut() == brute_cut(texts, 20)
    spans = substring_dedup.repeated_spans(docs).filter("id = 3").orderBy("start").collect()
    assert [(r["from_id"], r["step"]) for r in spans] == [(1, 0), (2, 1)] and len({r["chain"] for r in spans}) == 1
    real = substring_dedup.chains
    monkeypatch.setattr(substring_dedup, "chains", lambda paths: paths.withColumns({"chain": F.lit(1).cast("long"), "step": F.lit(0)}))
    assert cut() != brute_cut(texts, 20)
    monkeypatch.setattr(substring_dedup, "chains", lambda paths: real(paths).limit(0))
    assert all(removed == 0 for _, removed, _ in cut().values())


def test_chains_of_paths(spark):
    """1-2-3-4 is one chain; 4 is left by two paths, 7 entered by two; 10-11-10 is a ring; 20-21 stands alone."""
    pairs = [(1, 2), (2, 3), (3, 4), (4, 5), (4, 6), (8, 7), (9, 7), (7, 12), (12, 13), (10, 11), (11, 10), (20, 21)]
    got = {(r["tail"], r["head"]): (r["chain"], r["step"]) for r in substring_dedup.chains(spark.createDataFrame(pairs, "tail long, head long")).collect()}
    assert len(got) == len(pairs) and len({got[p][0] for p in pairs[:3]}) == 1 and [got[p][1] for p in pairs[:3]] == [0, 1, 2]
    assert got[7, 12][0] == got[12, 13][0] and [got[p][1] for p in ((7, 12), (12, 13))] == [0, 1]
    alone = [(4, 5), (4, 6), (8, 7), (9, 7), (10, 11), (11, 10), (20, 21)]
    assert len({got[p][0] for p in alone} | {got[1, 2][0], got[7, 12][0]}) == len(alone) + 2


def test_long_chains(spark):
    pairs = [(i, i + 1) for i in range(37)]
    got = {r["tail"]: (r["chain"], r["step"]) for r in substring_dedup.chains(spark.createDataFrame(pairs, "tail long, head long")).collect()}
    assert {c for c, _ in got.values()} == {1} and [got[i][1] for i in range(37)] == list(range(37))


def test_rows_with_hot_keys_stay(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_KEYS", 4)
    rows = spark.createDataFrame([(1 if i % 2 else i % 7, i) for i in range(100)], "k long, i long")
    right = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), (F.col("k") * 10).alias("v")).filter("k <> 3")
    got = common.join_counted(rows, right, ["k"], "n", 100, ["i"])
    assert sorted((r["k"], r["i"], r["v"]) for r in got.collect()) == sorted((r["k"], r["i"], r["k"] * 10) for r in rows.collect() if r["k"] != 3)


def test_substring_of_the_awkward(spark, awkward, empty):
    rows = substring_dedup.cut_repeats(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(r["n_words"] == 0 and r["kept"] == "" for r in rows if r["id"] in (1, 2, 3))
    assert {(r["n_words"], r["n_removed"]) for r in rows if r["id"] == 4} == {(20000, brute_cut({0: awkward.filter("doc_id = 4").first()["text"]}, 20)[0][1])}
    assert substring_dedup.cut_repeats(empty).count() == 0


# Language.


def test_held_out_languages(spark):
    rows = LLM_QUERIES["op7_language"](spark, "/root/testdata/sf0.01").filter("held_out").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert rows.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98


def plain_vector(text):
    """The bundled vector of a text, trigram by trigram."""
    out = np.zeros(language.DIMENSIONS)
    for word in regex.findall(r"\p{Alphabetic}+", "".join(c if c.isalpha() else " " for c in text.lower())):
        codes = [0, *map(ord, word), 0]
        for abc in zip(codes, codes[1:], codes[2:]):
            a, b, c = (language.letter_vector(x).astype(np.int64) for x in abc)
            out += np.roll(a, 2) * np.roll(b, 1) * c
    return out


def plain_profiles(rows):
    sums = collections.defaultdict(lambda: np.zeros(language.DIMENSIONS))
    for text, lang in rows:
        v = plain_vector(text or "")
        if lang is not None and v.any():
            sums[lang] += v / np.sqrt((v * v).sum())
    return {k: v / np.sqrt((v * v).sum()) for k, v in sums.items()}


def plain_cosines(profiles, text):
    v = plain_vector(text or "")
    return {k: float(p @ v / np.sqrt((v * v).sum())) for k, p in profiles.items()} if v.any() else {}


def test_language_query_equals_a_plain_loop(spark):
    docs = documents(spark).collect()
    fold = lambda i: zlib.crc32(str(i).encode()) % 3
    profiles = plain_profiles([(r["text"], r["lang"]) for r in docs if fold(r["doc_id"]) != 1])
    got = {r["doc_id"]: r for r in LLM_QUERIES["op7_language"](spark, FOLDER).collect()}
    assert len(got) == len(docs)
    for r in docs:
        near, row = plain_cosines(profiles, r["text"]), got[r["doc_id"]]
        best = max(near, key=lambda k: (near[k], [-ord(c) for c in k])) if near else "und"
        assert row["held_out"] == (fold(r["doc_id"]) == 1) and row["score"] == pytest.approx(max(0, near.get(best, 0)), abs=1e-4)
        assert row["lang_pred"] == best or near[row["lang_pred"]] == pytest.approx(near[best], abs=1e-4)


def test_stated_languages_are_refuted(spark):
    en, de, none = "the cat and the dog of the house " * 20, "der hund und die katze in dem haus " * 20, "xq zqx qzz vvx " * 40
    docs = spark.createDataFrame([(0, en, "en"), (1, en, "de"), (2, en, None), (3, en, "xx"), (4, none, None), (5, "xq", "de"), (6, "", "en"), (7, None, None), (8, "12", "en"), (8, de, "de"), (8, de, "de")], "doc_id long, text string, lang string")
    profiles = language.learn(spark.createDataFrame([(en, "en"), (de, "de")], "text string, lang string"))
    assert sorted(r["doc_id"] for r in language.keep_identified(docs, profiles).collect()) == [0, 2, 3, 5, 8, 8] if profiles.names else True
    assert language.keep_identified(docs.drop("lang"), profiles).filter("doc_id = 1").count() == 1


def test_language_of_the_awkward(spark, awkward, empty):
    profiles = language.learn(spark.createDataFrame([("der die und das", "de"), ("the and of", "en"), (None, "xx"), ("1 2", "yy"), ("und", None)], "text string, lang string"))
    assert profiles.names == ["de", "en"]
    docs = spark.createDataFrame([(1, "und die"), (2, None), (3, "12 !"), (4, ""), (5, "漢字" * 3), (6, "the the")], "doc_id long, text string")
    got = {r["id"]: (r["lang_pred"], r["score"]) for r in language.identify(docs, profiles).collect()}
    assert got[1][0] == "de" and got[6][0] == "en" and got[2] == got[3] == got[4] == ("und", 0.0) and 0 <= got[5][1] <= 1
    assert language.identify(awkward, profiles).count() == awkward.count()
    kept = language.keep_identified(awkward, profiles)
    assert kept.columns == awkward.columns and {1, 2, 3}.isdisjoint(r["doc_id"] for r in kept.collect())
    nobody = language.learn(empty)
    assert nobody.names == [] and {r["lang_pred"] for r in language.identify(awkward, nobody).collect()} == {"und"}


def test_letters_are_bound_by_place():
    one, two = language.bundle(["abc", "cba"])
    assert not np.array_equal(one, two)
    assert np.array_equal(language.bundle(["ab"] * 3)[2], language.bundle(["ab"])[0])


# Secrets.


def test_secrets(spark, awkward, empty):
    rng = random.Random(9)
    hexa = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = []
    for i in range(300):
        text = "some plain words of text internationalizationwords and more"
        text += f' token = "{hexa()}" end' if i % 3 == 0 else f" commit {hexa()} done" if i % 3 == 1 else ""
        rows.append((i, text, f"src/{i}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = secrets.scan(docs).collect()
    assert {r["id"] for r in found if r["secret"]} == {i for i in range(300) if i % 3 == 0}
    given = spark.createDataFrame([(r["id"], r["pos"], 1 if r["id"] % 3 == 1 and len(r["core"]) == 40 else 0) for r in found], "id long, pos int, label int")
    assert {r["id"] for r in secrets.scan(docs, given).collect() if r["secret"]} == {i for i in range(300) if i % 3 == 1}
    assert all(x > 0.9 for x in secrets.held_out_quality(docs).first())
    assert secrets.scan(empty).count() == 0
    assert {r["id"] for r in secrets.scan(awkward).collect()} == {9}


def test_every_token_of_a_word(spark):
    a, b, c = "A1b2C3d4E5f6G7h8I9j0K", "Z9y8X7w6V5u4T3s2R1q0P", "abcdefghijklmnopqrstuv"
    texts = [f'x {{"id":"{a}","password":"{b}"}} y', f"{c}.{a}.{b}", f"https://host.org/{c}?token={a}", f"{a},{a}==", f"one {a}"]
    docs = spark.createDataFrame([(i, t, "p") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    known = secrets.dictionary(docs)
    rows = {(r["id"], r["pos"], r["place"]): r for r in secrets.features(secrets.candidates(docs), known).collect()}
    got = {k: r["core"] for k, r in rows.items()}
    want = {(0, 1, 0): a, (0, 1, 1): b, (1, 0, 0): f"{c}.{a}.{b}", (2, 0, 1): a, (3, 0, 0): a, (3, 0, 1): a + "==", (4, 1, 0): a}
    assert got == want | {(2, 0, 0): got[2, 0, 0]} and got[2, 0, 0].endswith(c)
    assert [rows[0, 1, k]["named"] for k in (0, 1)] == [rows[2, 0, k]["named"] for k in (0, 1)] == [0, 1]
    assert rows[4, 1, 0]["word"] == a and rows[0, 1, 1]["assigned"] == rows[0, 1, 1]["quoted"] == 1
    labels = spark.createDataFrame([(0, 1, 0, 0), (0, 1, 1, 1), (2, 0, 0, 0), (2, 0, 1, 1)], "id long, pos int, place int, label int")
    assert {(r["id"], r["pos"], r["place"]) for r in secrets.scan(docs, labels).collect()} == set(rows)


def test_candidates_are_those_of_a_plain_loop(spark):
    docs = documents(spark)
    more = [(-1, 'a "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMeK" b', "x"), (-2, "-----BEGIN KEY-----\nMIIEvQIBADANBgkqhkiG9w0BAQ\nEFAASCBKcwggSjAgEAAoIBAQ==\n-----END", None), (-3, "a\x0b" + "k9" * 12 + "\x0c" + "Z" * 19, "")]
    docs = docs.select("doc_id", "text", "source").union(spark.createDataFrame(more, "doc_id long, text string, source string"))
    want = []
    for r in docs.collect():
        for pos, word in enumerate(re.split(r"[\x20\x09-\x0D]+", r["text"] or "")):
            want += [(r["doc_id"], pos, place, m) for place, m in enumerate(re.findall(secrets.CORE, word))]
    got = [(r["id"], r["pos"], r["place"], r["core"]) for r in secrets.candidates(docs).collect()]
    assert sorted(got) == sorted(want) and {w[0] for w in want} >= {-1, -2, -3}


def test_forest_on_findings_it_never_saw(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = secrets.planted(docs)
    assert {(r["label"], r["held_out"]) for r in rows.select("label", "held_out").distinct().collect()} == {(0.0, False), (0.0, True), (1.0, False), (1.0, True)}
    precision, recall = secrets.held_out_quality(docs).first()
    assert precision > 0.9 and recall > 0.9
    found = LLM_QUERIES["op8_secret_scan"](spark, "/root/testdata/sf0.01").collect()
    assert {r["secret"] for r in found if r["token"].isalpha()} == {False} and all(r["secret"] for r in found if len(r["token"]) == 40 and not r["token"].isalpha())


# Exact deduplication.


def test_collisions_are_kept_apart(spark):
    docs = spark.createDataFrame([(3, "a b"), (1, "a  b"), (2, "c"), (4, "c"), (5, "a b "), (6, None), (7, "")], "doc_id long, text string")
    weak = lambda sha: F.substring(F.lit(b"0" * 16), 1, 16)
    for hash128 in (exact_dedup.leading_128_bits, weak):
        got = {r["id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_groups(docs, hash128=hash128).collect()}
        assert got == {3: (1, 2, False), 1: (1, 2, True), 2: (2, 2, True), 4: (2, 2, False), 5: (5, 1, True), 6: (6, 2, True), 7: (6, 2, False)}


def test_copies_with_repeated_ids(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (2, "a"), (2, "c"), (3, "b"), (None, "d"), (None, "d"), (None, "a"), (4, "d"), (5, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for hash128 in (exact_dedup.leading_128_bits, lambda sha: F.substring(F.lit(b"0" * 16), 1, 16)):
        assert sorted(tuple(r) for r in exact_dedup.drop_exact_copies(docs, hash128=hash128).collect()) == [(1, "a"), (1, "b"), (2, "c"), (4, "d"), (5, "e")]
        got = sorted(((r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_groups(docs, hash128=hash128).collect()), key=repr)
        assert got == sorted([(1, 1, 4, True)] * 2 + [(1, 1, 2, True), (2, 1, 4, False), (2, 2, 1, True), (3, 1, 2, False), (None, 4, 3, False), (None, 4, 3, False), (None, 1, 4, False), (4, 4, 3, True), (5, 5, 1, True)], key=repr)


def test_exact_of_the_awkward(spark, awkward, empty):
    assert exact_dedup.exact_groups(awkward).count() == awkward.count()
    kept = exact_dedup.drop_exact_copies(awkward)
    assert kept.columns == awkward.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 3, 4, 6, 7, 8, 9]
    assert exact_dedup.exact_groups(empty).count() == 0 and exact_dedup.drop_exact_copies(empty).count() == 0


# Decontamination.


def test_phrases_and_proximity(spark, awkward, empty):
    item = " ".join(f"q{i}" for i in range(20))
    words = item.split()
    shuffled = " ".join([words[2], words[0], words[1], *words[3:13]])
    docs = spark.createDataFrame([(1, f"x {item.upper()} y"), (2, "nothing here"), (3, f"{shuffled} z"), (4, "Short, item!"), (5, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (8, "short item"), (9, None), (10, "...")], "item_id long, text string")
    found = {(r["id"], r["kind"]) for r in decontaminate.find_benchmark(docs, items).collect()}
    assert found >= {(1, "phrase"), (3, "near"), (4, "phrase")} and not {i for i, _ in found} & {2, 5}
    got = {r["id"]: (r["n_words"], r["n_hit"], r["contaminated"]) for r in decontaminate.contamination(docs, items).collect()}
    assert got == {1: (22, 20, True), 2: (2, 0, False), 3: (14, 0, False), 4: (2, 2, True), 5: (0, 0, False)}
    assert sorted(r["doc_id"] for r in decontaminate.drop_contaminated(docs, items).collect()) == [2, 3, 5]
    assert decontaminate.contamination(awkward, items).count() == awkward.count()
    assert decontaminate.drop_contaminated(awkward, items).columns == awkward.columns
    assert decontaminate.contamination(empty, items).count() == 0
    assert decontaminate.contamination(docs, items.limit(0)).filter("n_hit > 0").count() == 0


# Pipeline.


def test_pipeline_equals_brute_force(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in documents(spark).collect()}
    stated = {r["doc_id"]: r["lang"] for r in documents(spark).collect()}
    profiles = plain_profiles([(t, stated[i]) for i, t in docs.items()])
    stay = {}
    for i, t in docs.items():
        near = plain_cosines(profiles, t)
        best = max(near.values(), default=0)
        if near and not (best >= 0.5 and best - near.get(stated[i], best) >= 0.2) and not (len(t) >= 300 and best < 0.2):
            stay[i] = t
    seen, distinct = set(), {}
    for i in sorted(stay):
        norm = " ".join(stay[i].replace("\x1c", "\x1c").split(" "))
        norm = __import__("re").sub(r"[\x20\x09-\x0D]+", " ", norm)
        if norm not in seen:
            seen.add(norm)
            distinct[i] = stay[i]
    groups = brute_components(distinct, 5, 80)
    distinct = {i: t for i, t in distinct.items() if groups[i][1] == i}
    con = connect(folder)
    bad = {r[0] for r in con.execute(f"SELECT doc_id FROM ({decontaminate.ORACLE}) WHERE contaminated").fetchall()}
    want = {i: hashlib.sha256(t.encode()).hexdigest() for i, t in distinct.items() if i not in bad}
    assert {r["doc_id"]: r["decoded_sha256"] for r in corpus_pipeline.run(spark, folder).collect()} == want


def test_pipeline_stages_keep_the_columns(spark, empty):
    import corpus_pipeline

    none = documents(spark).limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, none, FOLDER).columns == none.columns and stage(spark, none, FOLDER).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, none, FOLDER).count() == 0


def test_pipeline_stages_on_the_awkward(spark, awkward):
    """Nulls, empty and long texts, ties, repeated rows and clashing names pass every stage with a defined result."""
    import corpus_pipeline

    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, awkward, FOLDER)
        assert rows.columns == awkward.columns, name
        kept[name] = sorted((r["doc_id"] for r in rows.collect()), key=lambda i: (i is None, i))
    assert kept["language"] == [0, 0, 5, 6, 7, 8, 9, None]
    assert kept["exact_dedup"] == [0, 1, 3, 4, 6, 7, 8, 9]
    assert kept["near_dedup"] == [1, 2, 3, 4, 4, 6, 7, 9, None, None]
    assert kept["decontaminate"] == sorted((r["doc_id"] for r in awkward.collect()), key=lambda i: (i is None, i))
    rows = corpus_pipeline.STAGES[-1][1](spark, awkward, FOLDER).collect()
    assert len(rows) == awkward.count() and {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)} == {0}


def test_every_shortest_stretch_is_near(spark):
    word = lambda i: f"w{i}"
    rng = random.Random(3)
    item = " ".join(map(word, range(13)))
    lay = lambda places: " ".join({p: word(k) for k, p in places}.get(p, f"f{p}") for p in range(60))
    texts = [lay([(0, 20), (1, 22), (2, 23), (0, 2)]), lay([(0, 20), (1, 22), (2, 23), (1, 41)]), lay([(0, 5), (1, 6), (2, 7), (2, 40), (1, 45), (0, 59)])]
    texts += [f"{item} " + lay([(2, 30), (0, 33), (1, 35)]), " ".join(rng.choice([word(rng.randrange(3)), "x", "y", "z"]) for _ in range(300)), " ".join(map(word, range(3, 13))) + " w3" * 9]
    texts += [" ".join(map(word, range(3, 13)))] * 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {(r["id"], r["start"], r["length"]) for r in decontaminate.find_benchmark(docs, items).collect() if r["kind"] == "near"}
    want = set()
    for doc, text in enumerate(texts):
        w = text.split()
        for s in range(len(w)):
            e = next((e for e in range(s, min(s + 21, len(w))) if {word(0), word(1), word(2)} <= set(w[s : e + 1])), None)
            if e is not None and not {word(0), word(1), word(2)} <= set(w[s + 1 : e + 1]) and not (text.startswith(item) and e < 13):
                want.add((doc, s, e - s + 1))
    assert {(0, 20, 4), (1, 20, 4), (2, 5, 3), (2, 40, 20), (3, 43, 6)} <= want and got == want


def test_tokens_are_the_words(spark):
    texts = [f"{a}one two{gap}{b}" for a in ("", " ", "\x85") for gap in (".", " \n", "") for b in ("\x85", "\u2028", "\u2029", "\r\n", "")]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", decontaminate._tokens(F.col("t")).alias("a"), decontaminate.words_of(F.col("t")).alias("b")).collect()
    assert [r["t"] for r in rows if r["a"] != r["b"]] == []
