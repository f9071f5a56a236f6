import collections
import hashlib
import itertools
import os
import random
import re

import numpy as np
import pytest

from oracle import connect, rows_of_duckdb, rows_of_spark

from jobsluice.llm import bpe, decontaminate, fill_middle, filter_audit, pii
from jobsluice.llm.queries import LLM_ORACLES, LLM_QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# Fill-in-middle.


@pytest.mark.parametrize("block", [1, 3, 64])
def test_cuts_are_those_of_split_lines(monkeypatch, block):
    monkeypatch.setattr(fill_middle, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(60):
        text = "".join(rng.choice("ab\n\né日😀") for _ in range(rng.randrange(0, 90)))
        lines = re.findall(r"[^\n]*\n|[^\n]+", text)
        tree = fill_middle.LineTree(np.frombuffer(text.encode(), np.uint8))
        assert tree.lines == len(lines)
        for k in range(len(lines) + 1):
            head = "".join(lines[:k])
            assert tree.cut(k) == (len(head.encode()), len(head))


@pytest.mark.parametrize(("rate", "spm"), [(100, 50), (40, 0), (0, 100)])
def test_fill_middle_of_the_awkward(spark, awkward, empty, rate, spm):
    marked = spark.createDataFrame([(50, "a\n<P>b", None, None, 0, None, None, None, None), (51, "<\nP>\nS><", None, None, 0, None, None, None, None), (52, "\n" * 5000 + "日本\n語", None, None, 0, None, None, None, None)], awkward.schema)
    docs = awkward.unionByName(marked)
    got = fill_middle.fill_in_middle(docs, 7, rate, spm)
    got = got.withColumn("restored", fill_middle.restored(got["output"], got["form"])).collect()
    texts = collections.Counter((r["doc_id"], r["text"] or "") for r in docs.collect())
    assert collections.Counter((r["id"], r["restored"]) for r in got) == texts
    for r in got:
        h = hashlib.sha256(f"7:{'' if r['id'] is None else r['id']}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
        text = r["restored"]
        lines = re.findall(r"[^\n]*\n|[^\n]+", text)
        low, high = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
        p, m, s = "".join(lines[:low]), "".join(lines[low:high]), "".join(lines[high:])
        plain = not text or re.search("<[PSM]>", text) or h3 % 100 >= rate
        form = "plain" if plain else "spm" if h4 % 100 < spm else "psm"
        want = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
        assert (r["n"], r["form"], r["output"], r["prefix_chars"], r["middle_chars"]) == (len(lines), form, want, None if plain else len(p), None if plain else len(m))
    assert fill_middle.fill_in_middle(empty, 7).count() == 0


# Personal data.

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")), "card": lambda: 12 <= len(digits) <= 19 and passes(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()
            found += [(m.start(), order, m.end())] * ok
    return sorted(found)


def odd_texts():
    rng = random.Random(12)
    cards = ["4111 1111 1111 1111", "4111-1111-1111-1111", "378282246310005", "4111111111111112", "0000 0000 0000"]
    bits = ["a@b.c", "x@y", "..q@r.s.t_", "%", "@", ".", "1.2.3.4", "256.1.1.1", "001.002.003.0255", "+1 (234) 555-6789", "+12", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", " ", "-", "--", "é", "😀", "7", "日 ", "\n", "5.6"] + cards
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 30))) for _ in range(300)]


def test_plain_findings_are_those_of_a_plain_loop(spark, awkward, monkeypatch):
    monkeypatch.setattr(pii, "FOLD", 4)
    texts = [*odd_texts(), "1 " * 5000, "9" * 3000, "x" * 3000 + "@", "a@b.c " * 500, "." * 2000, None, ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["id"]: [tuple(s)[:3] for s in r["base"]] for r in pii.proposals(docs).collect()}
    assert got == {i: plain_spans(t or "") for i, t in enumerate(texts)}


def test_trees_add_what_the_plain_forms_miss(spark, awkward, empty):
    """Forms that no plain pattern has are added, look-alikes are not, and plain findings stay."""
    filler = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(i, f"{filler} {i} {filler}") for i in range(1500)]
    said = {2000: ("write to jsmith (at) example (dot) org today", "email"), 2001: ("call (030) 555 1234 or so", "phone"), 2002: ("host 10[.]20[.]30[.]40 is up", "ip"), 2003: ("card 4111/1111/1111/1111 was used", "card")}
    clean = {2100: "version 12 . 4 . 100 . 7 came", 2101: "order 123.456.789 went", 2102: "she was at home. then left", 2103: "invoice no. 4111/1111/1111/1112 paid", 2104: "mail a@b.org or +1 (234) 555-6789 or 10.0.0.1"}
    rows += [(k, f"{filler} {t} {filler}") for k, (t, _) in said.items()] + [(k, f"{filler} {t} {filler}") for k, t in clean.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["id"]: r for r in pii.find(docs).collect()}
    assert len(got) == len(rows)
    texts = dict(rows)
    for k, (_, kind) in said.items():
        assert [pii.KINDS[s["kind"]] for s in got[k]["added"]] == [kind], texts[k]
    assert all(not got[k]["added"] for k in clean) and not any(got[i]["added"] for i in range(1500))
    assert [tuple(s) for s in got[2104]["base"]] == plain_spans(texts[2104])


def test_pii_of_the_awkward(spark, awkward, empty):
    rows = awkward.unionByName(spark.createDataFrame([(None, "é a@b.org 😀 +1 (234) 555-6789", None, None, 0, None, None, None, None)] * 2, awkward.schema))
    found = pii.find(rows)
    assert found.count() == rows.count()
    twice = found.filter("id is null and size(base) > 0").collect()
    assert len(twice) == 2 and [tuple(s) for s in twice[0]["base"]] == [(2, 0, 9), (12, 3, 29)]
    assert pii.find(empty).count() == 0
    out = spark.createDataFrame([("é a@b.org 😀 +1 (234) 555-6789!",)], "text string").crossJoin(found.filter("id is null and size(base) > 0").limit(1))
    assert out.select(pii.redacted(out["text"], out["base"])).first()[0] == "é <email> 😀 <phone>!"


def test_long_texts_take_no_longer_by_the_square(spark):
    texts = ["1 " * 200000, "9" * 400000, "x" * 400000 + "@", "a@b.c " * 20000, "." * 200000, "1.2.3.4 " * 20000]
    found = pii.proposals(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).selectExpr("id", "size(base) as n", "try_element_at(base, -1).end as last").collect()
    assert {r["id"]: (r["n"], r["last"]) for r in found if r["n"]} == {3: (20000, 6 * 20000 - 1), 5: (20000, 8 * 20000 - 1)}


# Filter interaction audit.


def plain_audit(rows, labels, names="ABCDE"):
    docs = {}
    for i, text, part in rows:
        docs.setdefault(i, []).append((text or "", part or ""))
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))

    def fails(i, text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        held = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search("[#$%&*|]", text)), "E": i is not None and text in first and i > first[text]}
        return {k for k, v in held.items() if v}

    failed = {i: set().union(*(fails(i, t) for t, _ in v)) for i, v in docs.items()}
    part_of = {i: min(p for _, p in v) for i, v in docs.items()}
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in (0, 1))
    out = {}
    for part in set(part_of.values()):
        own = [i for i in part_of if part_of[i] == part]
        shapley = collections.Counter()
        for order in itertools.permutations(names):
            alive = set(own)
            for step, f in enumerate(order, 1):
                removed = {i for i in alive if f in failed[i]}
                redundant = sum(f in failed[i] for i in own) - len(removed)
                alive -= removed
                out[part, "".join(order), step] = [len(alive), len(removed), redundant, sum(failed[i] == {f} for i in own), len(removed & good), len(removed & toxic)]
                shapley[f] += len(removed)
        for order in itertools.permutations(names):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step].append(shapley[f])
    return out


def test_audit_is_that_of_all_orders(spark):
    rng = random.Random(13)
    word = lambda: rng.choice(["wort", "text", "NOTE", "a", "b", "c#", "z", "fünf", "100%", *[f"w{k}" for k in range(60)]])
    rows = [(rng.randrange(70), " ".join(word() for _ in range(rng.choice([3, 60, 80, 200]))), rng.choice(["x", "y", None, ""])) for _ in range(80)]
    rows += [(200 + k, rows[k % 5][1], "x") for k in range(30)] + [(None, "a", "y"), (None, None, "x"), (301, None, None), (302, "", "y")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in [*range(60), *range(20), None, 999]]
    docs = spark.createDataFrame([(i, t, None, p, 0) for i, t, p in rows], DOCS)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    members, failing = filter_audit.failing_ids(docs)
    got = {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in filter_audit.audit(members, failing, marks).collect()}
    assert got == plain_audit(rows, labels)


def test_audit_of_the_awkward(spark, awkward, empty):
    marks = spark.createDataFrame([(0, 1, 0), (0, 1, 1)], "doc_id long, quality int, toxic int")
    members, failing = filter_audit.failing_ids(awkward)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in awkward.collect()]
    got = {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in filter_audit.audit(members, failing, marks).collect()}
    assert got == plain_audit(rows, [(0, 1, 0), (0, 1, 1)])
    members, failing = filter_audit.failing_ids(empty)
    assert filter_audit.audit(members, failing, marks).count() == 0
    with pytest.raises(ValueError, match="filters"):
        filter_audit.audit(members, {}, marks)


def test_audit_rests_on_the_tables_of_ids(spark):
    """Two filters given as tables of ids; one id in both, one in neither."""
    members = spark.createDataFrame([(1, "p"), (2, "p"), (3, "p"), (4, "q")], "id long, part string")
    failing = {"left": spark.createDataFrame([(1,), (2,), (2,), (9,)], "id long"), "right": spark.createDataFrame([(2,)], "id long")}
    got = {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["shapley"]) for r in filter_audit.audit(members, failing, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()}
    assert got == {("p", "leftright", 1): (1, 2, 0, 1, 3), ("p", "leftright", 2): (1, 0, 1, 0, 1), ("p", "rightleft", 1): (2, 1, 0, 0, 1), ("p", "rightleft", 2): (1, 1, 1, 1, 3), **{("q", o, s): (1, 0, 0, 0, 0) for o in ("leftright", "rightleft") for s in (1, 2)}}


def test_new_queries_are_registered():
    assert {"op11_fill_middle", "op12_pii", "op13_filter_audit"} <= set(LLM_QUERIES)


# What is beyond a broadcast, and what is remembered.


@pytest.mark.parametrize("bound", ["BROADCAST_ROWS", "BROADCAST_BYTES"])
def test_decontamination_without_broadcasts(spark, monkeypatch, bound):
    """Beyond either bound of a broadcast words cross a shuffle with their surroundings, not with their text."""
    monkeypatch.setattr(decontaminate, bound, -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.createDataFrame([(1, "a b c d"), (2, "x a")], "doc_id long, text string")
        plan = decontaminate.postings(docs, spark.createDataFrame([("a",), ("d",)], "term string"), "doc_id", "text", 2)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(term" in plan and "near#" in plan.split("Exchange hashpartitioning(term")[1].split("Generate")[0]
        assert not re.search(r"[\[ ]w#\d+[,\]]", plan.split("Generate")[0])  # the words are cut, not handed on
        folder = "/root/testdata/sf0.001"
        assert rows_of_spark(LLM_QUERIES["op10_decontaminate"](spark, folder)) == rows_of_duckdb(connect(folder), LLM_ORACLES["op10_decontaminate"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def contaminated(spark):
    item = " ".join(f"q{i}" for i in range(20))
    docs = [(1, f"x {item} y"), (2, "nothing here"), (3, "Short, item!"), (None, item), (None, "q0 q1"), (3, "other words"), (4, None), (4, ""), (5, f"{item} {item}")]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item), (8, "short item")], "item_id long, text string")


def _shuffles(df):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])


def test_lists_meet_by_one_shuffle(spark, contaminated):
    """Lists of a window's anchors are intersected with one shuffle of the postings, not two."""
    phrases = decontaminate.find_benchmark(*contaminated).filter("kind = 'phrase'")
    assert len([keys for keys in _shuffles(phrases) if "window_id#" in keys and "start#" in keys]) == 1
    assert {(r["id"], r["start"]) for r in phrases.collect()} == {(i, s) for i, first in ((1, [1]), (None, [0]), (5, [0, 20])) for f in first for s in range(f, f + 8)} | {(3, 0)}


@pytest.mark.parametrize("bound", [None, "BROADCAST_ROWS", "BROADCAST_BYTES"])
def test_documents_are_dropped_without_a_shuffle(spark, monkeypatch, contaminated, bound):
    """Whole documents cross a shuffle only where those that go are too many for a broadcast."""
    if bound:
        monkeypatch.setattr(decontaminate, bound, -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = decontaminate.drop_contaminated(*contaminated)
        assert bool(_shuffles(rows)) == bool(bound)
        assert sorted((r["doc_id"], r["text"] or "") for r in rows.collect()) == [(2, "nothing here"), (4, ""), (4, "")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_index_goes_with_its_use(spark, monkeypatch, contaminated):
    """Windows, anchors and postings are deleted once the documents with matches are known; find_benchmark's stay."""
    kept = []
    monkeypatch.setattr(decontaminate, "stored", lambda df, name="table", put=decontaminate.stored: kept.append((name, put(df, name))) or kept[-1][1])
    folders = lambda: {name for name, df in kept if os.path.exists(df._stored_path.removeprefix("file://"))}
    assert decontaminate.contamination(*contaminated).filter("contaminated").count() == 6
    assert {"windows", "anchors", "postings", "hit"} <= {name for name, _ in kept}
    assert not folders() & {"windows", "anchors", "postings"} and "hit" in folders()
    kept.clear()
    found = decontaminate.find_benchmark(*contaminated)
    assert found.count() and folders() >= {"windows", "anchors", "postings"}


def test_long_words_leave_what_is_known(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    known = {}
    for word in ("a", "b", "c", "d"):
        bpe._remember(known, word, b"1")
    assert known == {"d": b"1"}
