"""Personal data: generators propose spans, boosted trees judge those beyond the plain forms, thresholds are calibrated."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from jobsluice.llm.common import SPACES, read, stored, text_of

KINDS = ["email", "ip", "card", "phone"]
#: Characters before and after a candidate that its context inputs see.
NEAR = 40
#: Numbers summed up in one fold; longer arrays are folded in blocks of so many.
FOLD = 256
#: Bound of the findings planted to learn from; of so many one is kept from the trees, to set the thresholds.
PLANTED, HELD_OUT = 6000, 3
ROUNDS, DEPTH, SEED = 10, 3, 12
#: Least share of right findings among those held out that a threshold lets through.
PRECISION = 0.98
#: Words that speak for a kind when they stand before a candidate, and words that speak against any.
CUES = {
    "email": r"(?i)(mail|contact|write|reach|address)\W*$",
    "ip": r"(?i)(ip|host|server|login|client|addr\w*|from)\W*$",
    "card": r"(?i)(card|visa|mastercard|amex|credit|debit|payment|cc)( number| no\.?| nr\.?)?\W*$",
    "phone": r"(?i)(phone|tel|call|fax|mobile|cell|dial|whatsapp|sms)\.?( at| us at| number| no\.?| nr\.?)?\W*$",
}
AGAINST = r"(?i)(version|isbn|issn|order|invoice|ref|reference|part|page|date|build|item|total|price|serial|id|no\.?|v)\W*$"

LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"


class Generator(NamedTuple):
    """A pattern that proposes spans of a kind; ``holds`` drops proposals of it. Plain ones are findings, others are judged."""

    kind: str
    pattern: str
    plain: bool
    holds: Callable[[Column], Column]


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether digits pass the checksum: from the right every second one counts double, less 9 from 10 on."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 1, F.translate(c, "0123456789", "0246813579")).otherwise(c).try_cast("int"))
    return F.aggregate(values, F.lit(0), lambda total, v: total + F.coalesce(v, F.lit(0))) % 10 == 0


def _between(low: int, high: int) -> Callable[[Column], Column]:
    return lambda m: F.length(_digits(m)).between(low, high)


def _card(match: Column) -> Column:
    return F.when(_between(12, 19)(match), luhn(_digits(match))).otherwise(False)


def _ip(match: Column) -> Column:
    """No part above 255, however many leading zeros it has."""
    return F.forall(F.split(match, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))).between(0, 3) & (F.coalesce(p.try_cast("decimal(38,0)"), F.lit(0)) <= 255))


# The plain forms are those of the contract, written so that a search is linear: a match can begin only where no
# character that it could begin with stands before it, or where the match before ended (\G), and what a repetition has
# taken it keeps (++), as what follows never is of its class.
_AFTER = r"(?:(?<!{})|\G)"
GENERATORS = [
    Generator("email", _AFTER.format(LOCAL) + rf"{LOCAL}++@{LABEL}++(?:\.{LABEL}++)++", True, lambda m: F.lit(True)),
    Generator("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", True, _ip),
    Generator("card", r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+", True, _card),
    Generator("phone", r"\+[0-9][\x20().0-9-]+[0-9]", True, _between(9, 15)),
    Generator("email", rf"(?<!{LOCAL}){LOCAL}++\x20?+(?:\(at\)|\[at\]|\{{at\}}|\x20at\x20|\x20AT\x20)\x20?+{LABEL}++(?:\x20?(?:\(dot\)|\[dot\]|\{{dot\}}|\x20dot\x20|\x20DOT\x20|\.)\x20?{LABEL}++)++", False, lambda m: F.lit(True)),
    Generator("ip", r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])", False, lambda m: F.lit(True)),
    Generator("ip", r"(?<![0-9.])[0-9]{1,3}(?:\x20?[\[(]?\.[\])]?\x20?[0-9]{1,3}){3}(?![0-9.])", False, lambda m: m.rlike(r"[^0-9.]")),
    Generator("card", r"(?<![0-9])[0-9]{4}(?:[.\x20/_-]{1,2}[0-9]{4,6}){2,3}(?:[.\x20/_-]{1,2}[0-9]{1,5})?(?![0-9])", False, _between(12, 19)),
    Generator("phone", r"(?<![0-9+.])\(?[0-9]{2,5}\)?(?:[\x20./-]{1,2}[0-9]{2,5}){2,4}(?![0-9])", False, _between(7, 13)),
]
PLAIN = 4


def _running(xs: Column) -> Column:
    """Running sums of a short array of long."""
    start = F.struct(F.lit(0).cast("long").alias("s"), F.array().cast("array<bigint>").alias("a"))
    return F.aggregate(xs, start, lambda acc, x: F.struct((acc["s"] + x).alias("s"), F.concat(acc["a"], F.array(acc["s"] + x)).alias("a")))["a"]


def _blocks(xs: Column) -> Column:
    """The array in blocks of FOLD, so that a fold never copies a long one."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / FOLD).cast("int")), lambda b: F.slice(xs, b * FOLD + 1, FOLD))


def _placed(generators: Column, plain: bool) -> Column:
    """Array of the spans of all generators; those that are judged carry their text and what stands around it."""

    def of_one(p: Column) -> Column:
        def placed(m: Column, i: Column) -> Column:
            start, number = F.get(p["s"], i), p["k"]
            checks, kind = F.lit(True), F.lit(0)
            for k, g in enumerate(GENERATORS):
                if g.plain == plain:
                    checks, kind = F.when(number == k, g.holds(m)).otherwise(checks), F.when(number == k, KINDS.index(g.kind)).otherwise(kind)
            near = [] if plain else [m.alias("match"), F.right(F.get(p["g"], i), F.lit(NEAR)).alias("before"), F.left(F.get(p["g"], i + 1), F.lit(NEAR)).alias("after")]
            return F.when(F.coalesce(checks, F.lit(False)), F.struct(start.alias("start"), kind.alias("kind"), (start + F.length(m)).alias("end"), number.alias("generator"), *near))

        return F.array_compact(F.transform(p["m"], placed))

    chosen = F.filter(generators, lambda p: p["k"] < PLAIN if plain else p["k"] >= PLAIN)
    return F.flatten(F.transform(chosen, of_one))


def _with(kept: list[str], name: str, of: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda p: F.struct(*[p[c].alias(c) for c in kept], of(p).alias(name))


def proposals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: tuple[str, ...] = ()) -> DataFrame:
    """id, sha (of the text), base and wide: arrays of the proposals of the plain and of the other generators.

    Spans are in code points, the end exclusive. One narrow pass over whole texts: a generator's matches and the gaps
    between them, found once each, give the places. Null texts are empty and have none.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), *more)
    text = F.col("text")
    # What no span of a generator lacks is looked for first; most texts have none.
    digit, signs = text.rlike("[0-9]"), {0: text.contains("@"), 3: text.contains("+"), 4: text.rlike(r"(?i)[(\[{\x20]at[)\]}\x20]"), 5: text.rlike("[0-9A-Fa-f]:[0-9A-Fa-f]")}
    sha = F.unhex(F.left(F.sha2("text", 256), F.lit(32))).alias("sha")
    patterns = [g.pattern for g in GENERATORS]
    found = [F.when(signs.get(k, digit), F.regexp_extract_all("text", F.lit(p), F.lit(0))).alias(f"m{k}") for k, p in enumerate(patterns)]
    rows = rows.select("id", sha, "text", *more, *found)
    parts = [F.when(F.size(f"m{k}") > 0, F.struct(F.lit(k).alias("k"), F.col(f"m{k}").alias("m"), F.split("text", p, -1).alias("g"))) for k, p in enumerate(patterns)]
    rows = rows.select("id", "sha", *more, F.array_compact(F.array(*parts)).alias("p"))
    step = lambda p: F.transform(F.slice(p["g"], 1, F.size(p["m"])), lambda g, i: (F.length(g) + F.when(i > 0, F.length(F.get(p["m"], i - 1))).otherwise(0)).cast("long"))
    moved = lambda p: F.flatten(F.transform(p["b"], lambda block, i: F.transform(block, lambda v: v + F.when(i > 0, F.get(p["c"], i - 1)).otherwise(0))))
    # Places are running sums over blocks, and over the blocks' ends. Each stage is a column of its own: what a lambda is
    # made of is worked out again for each of its elements.
    stages = [("t", step), ("t", lambda p: _blocks(p["t"])), ("b", lambda p: F.transform(p["t"], _running)), ("c", lambda p: _running(F.transform(p["b"], lambda x: F.element_at(x, -1)))), ("s", moved)]
    held = {"k", "m", "g"}
    for name, of in stages:
        kept = [c for c in ("k", "m", "g", "t", "b", "c") if c in held and c != name and not (c == "t" and name in ("c", "s"))]
        rows = rows.select("id", "sha", *more, F.transform("p", _with(kept, name, of)).alias("p"))
        held = {*kept, name}
    return rows.select("id", "sha", F.array_sort(_placed(F.col("p"), True)).alias("base"), _placed(F.col("p"), False).alias("wide"), *more)


FEATURES = ["kind", "generator", "length", "digits", "groups", "separators", "zero", "paren", "luhn", "same", "year", "cue", "against", "wordlike", "touching"]


def features(found: DataFrame) -> DataFrame:
    """Adds the trees' inputs to candidates: their format, and what stands around them."""
    match, before, after = F.col("match"), F.col("before"), F.col("after")
    cue = F.element_at(F.array(*[before.rlike(CUES[k]) for k in KINDS]), F.col("kind") + 1)
    signs = F.array_distinct(F.split(F.regexp_replace(match, "[A-Za-z0-9]", ""), ""))
    groups = F.split(match, "[^A-Za-z0-9]+")
    number = lambda c: c.cast("double")
    values = {
        "kind": F.col("kind"),
        "generator": F.col("generator"),
        "length": F.length(match),
        "digits": F.length(_digits(match)),
        "groups": F.size(groups),
        "separators": F.size(signs),
        "zero": match.rlike(r"^\(?0"),
        "paren": match.rlike(r"[(\[{]"),
        "luhn": luhn(_digits(match)),
        "same": F.size(F.array_distinct(F.transform(groups, F.length))),
        "year": match.rlike(r"(^|[^0-9])(19|20)[0-9]{2}([^0-9]|$)"),
        "cue": cue,
        "against": before.rlike(AGAINST),
        "wordlike": match.rlike(r"^[a-z]{1,12} (at|AT) [a-z]+\b"),
        "touching": before.rlike("[A-Za-z0-9_#$]$") | after.rlike("^[A-Za-z0-9_%€$]"),
    }
    return found.select("*", *[F.coalesce(number(v), F.lit(0.0)).alias(f"f_{k}") for k, v in values.items()])


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Candidates whose outcome is known because they were put there: proposals' columns, label and held_out.

    Up to PLANTED texts in the order of a digest of their id lend four words before a place and three after it. Between them
    stands personal data in a form that the plain patterns miss (label 1), or what is often mistaken for it (label 0). Only
    the chosen texts are split. Labels tell what was put in, which no input of the trees knows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    total = rows.count()
    rows = rows.withColumn("h", F.sha2(F.concat(F.lit("planted "), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256))
    if total > 2 * PLANTED:
        # Digests are even, so that about twice as many as wanted are sorted, however large the table is.
        rows = rows.filter(F.conv(F.left("h", F.lit(13)), 16, 10).cast("long") < int(2 * PLANTED / total * 16**13))
    pick = lambda n, k: (F.pmod(F.xxhash64("h", F.lit(k)), F.lit(n)) + 1).cast("int")
    one_of = lambda k, *words: F.element_at(F.array(*map(F.lit, words)), pick(len(words), k))
    rows = rows.select("h", F.split(F.substring("text", 1, 4000), f"[{SPACES}]+").alias("w"))
    place = F.greatest(F.lit(1), F.least(F.size("w") - 7, pick(400, 61)))
    cut = lambda first, n: F.array_join(F.transform(F.slice("w", first, n), lambda x: F.left(x, F.lit(60))), " ")
    rows = rows.select("h", cut(place, 4).alias("head"), cut(place + 4, 3).alias("tail")).orderBy("h", "head", "tail").limit(PLANTED)
    rows = rows.withColumn("number", F.translate(F.sha2(F.concat(F.lit("digits"), "h"), 256), "abcdef", "123456"))
    d = lambda first, n: F.substring("number", first, n)
    octet = lambda k: F.pmod(F.xxhash64("h", F.lit(k)), F.lit(256)).cast("string")
    name = one_of(20, "anna.li", "jsmith", "max_m", "info", "sales.team", "k.ito42", "office", "p-ruiz")
    host, top = one_of(21, "example", "mail-box", "post", "acme-corp", "web"), one_of(22, "com", "org", "net", "de", "co")
    at, dot = one_of(23, "(at)", "[at]", " (at) ", " [at] ", "{at}"), one_of(24, "(dot)", "[dot]", ".", " (dot) ", ".")
    rows = rows.withColumn("body", F.left(F.concat(one_of(25, "4", "5", "37"), d(3, 14)), F.lit(15)))
    rows = rows.withColumn("card", F.element_at(F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda x: F.concat("body", x.cast("string"))), luhn), 1))
    in_fours = lambda s, sep: F.concat_ws(sep, F.left(s, F.lit(4)), F.substring(s, 5, 4), F.substring(s, 9, 4), F.substring(s, 13, 4))
    card = F.element_at(F.array(*[in_fours(F.col("card"), sep) for sep in (".", "/", "_", "  ")]), pick(4, 26))
    wrong = F.concat("body", F.pmod(F.right("card", F.lit(1)).cast("int") + pick(9, 27), F.lit(10)).cast("string"))
    phone = F.element_at(F.array(
        F.concat(F.lit("("), F.lit("0"), d(4, 2), F.lit(") "), d(7, 3), F.lit(" "), d(11, 4)), F.concat(d(4, 3), F.lit("-"), d(7, 3), F.lit("-"), d(11, 4)),
        F.concat(F.lit("0"), d(4, 3), F.lit(" "), d(7, 3), F.lit(" "), d(11, 3)), F.concat(d(4, 3), F.lit("."), d(7, 3), F.lit("."), d(11, 4)), F.concat(F.lit("00"), d(4, 2), F.lit(" "), d(7, 3), F.lit(" "), d(11, 5)),
    ), pick(5, 28))
    address = F.element_at(F.array(F.concat_ws("[.]", octet(1), octet(2), octet(3), octet(4)), F.concat_ws(" . ", octet(1), octet(2), octet(3), octet(4)), F.concat_ws(":", *[F.substring("h", 4 * k + 1, 4) for k in range(8)])), pick(3, 29))
    cue = lambda k, *words: F.when(pick(4, k) > 1, one_of(k + 1, *words)).otherwise("")
    day = F.call_function("concat_ws", one_of(30, "/", "-", "."), F.lpad(pick(28, 31).cast("string"), 2, "0"), F.lpad(pick(12, 32).cast("string"), 2, "0"), (pick(60, 33) + 1970).cast("string"))
    made = lambda kind, label, before, what: F.struct(F.lit(kind).alias("planted"), F.lit(label).alias("label"), F.coalesce(before, F.lit("")).alias("cue"), what.alias("what"))
    against = one_of(34, "order", "ref.", "invoice no.", "isbn", "item", "part", "serial", "version", "total")
    words = F.concat(one_of(35, "arrived", "look", "met", "stay", "was"), F.lit(" at "), one_of(36, "home", "noon", "paris", "the"), one_of(37, ". then", ".so", ". and", ".we"))
    kinds = [
        made(0, 1.0, cue(40, "mail:", "contact", "write to", "e-mail"), F.concat(name, at, host, dot, top)),
        made(0, 1.0, cue(42, "mail:", "contact", "reach me:"), F.concat(name, F.lit(" at "), host, F.lit(" dot "), top)),
        made(1, 1.0, cue(44, "host", "server", "from ip", "addr:"), address),
        made(2, 1.0, cue(46, "card", "visa:", "credit card number", "payment"), card),
        made(3, 1.0, one_of(48, "call", "tel.", "phone:", "mobile", "fax", "call us at", "phone number"), phone),
        made(3, 1.0, one_of(49, "phone:", "tel", "dial", "whatsapp"), phone),
        made(0, 0.0, F.lit(None), words),
        made(1, 0.0, against, F.concat_ws(" . ", octet(5), octet(6), d(1, 3), octet(7))),
        made(2, 0.0, F.when(pick(2, 50) == 1, against), in_fours(wrong, ".")),
        made(2, 0.0, against, in_fours(wrong, "/")),
        made(3, 0.0, against, F.concat_ws("-", d(1, 3), d(4, 1), d(5, 2), d(7, 4))),
        made(3, 0.0, F.when(pick(3, 51) == 1, F.lit("date")), F.concat(day, F.lit(" "), F.concat_ws("-", d(20, 2), d(22, 2)))),
        made(3, 0.0, F.when(pick(3, 52) > 1, against), F.call_function("concat_ws", one_of(53, ".", " ", "-"), d(1, 3), d(4, 3), d(7, 3))),
        made(3, 0.0, F.lit(None), F.concat_ws(" ", d(1, 2), d(3, 2), d(5, 3), d(8, 2))),
    ]
    rows = rows.withColumn("p", F.element_at(F.array(*kinds), pick(len(kinds), 60)))
    rows = rows.select("h", "p.*", "head", "tail", (pick(HELD_OUT, 62) == 1).alias("held_out"))
    head = F.concat("head", F.lit(" "), "cue", F.when(F.col("cue") == "", "").otherwise(" "))
    rows = rows.withColumn("from", F.length(head)).withColumn("text", F.concat(head, "what", F.lit(" "), "tail")).withColumn("to", F.col("from") + F.length("what"))
    found = proposals(stored(rows, "planted"), "h", "text", ("planted", "label", "held_out", "from", "to")).withColumn("c", F.explode("wide"))
    found = found.select("id", "planted", "label", "held_out", "from", "to", "c.*")
    shared = F.least("to", "end") - F.greatest("from", "start")
    right = (F.col("kind") == F.col("planted")) & (shared >= 0.8 * (F.greatest("to", "end") - F.least("from", "start")))
    return found.filter(shared > 0).withColumn("label", F.when(right, F.col("label")).otherwise(0.0)).drop("planted", "from", "to")


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="inputs").transform(rows)


def scored(rows: DataFrame, model: GBTClassificationModel) -> DataFrame:
    return model.transform(_assembled(rows)).withColumn("score", vector_to_array("probability")[1])


def fit(labelled: DataFrame) -> tuple[GBTClassificationModel, dict[int, float]] | None:
    """(trees, threshold by kind) from labelled candidates with inputs; None where one label is missing.

    Of the findings held out, a kind's threshold is the least score from 0.5 on from which PRECISION of them are right;
    a kind without such a score adds nothing.
    """
    rows = stored(labelled, "planted")
    learnt = rows.filter(~F.col("held_out"))
    if learnt.select("label").distinct().count() < 2:
        return None
    trees = GBTClassifier(featuresCol="inputs", labelCol="label", maxIter=ROUNDS, maxDepth=DEPTH, seed=SEED)
    model = trees.fit(_assembled(learnt.coalesce(4)))
    held = scored(rows.filter("held_out"), model).select("kind", "label", "score")
    levels = held.withColumn("level", F.explode(F.transform(F.sequence(F.lit(10), F.lit(19)), lambda x: x / 20))).filter(F.col("score") >= F.col("level"))
    levels = levels.groupBy("kind", "level").agg(F.avg("label").alias("precision"), F.count(F.lit(1)).alias("n"))
    best = levels.groupBy("kind").agg(F.min(F.when((F.col("precision") >= PRECISION) & (F.col("n") >= 10), F.col("level"))).alias("least"))
    return model, {r["kind"]: r["least"] for r in best.collect() if r["least"] is not None}  # a row for each kind


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled: DataFrame | None = None) -> DataFrame:
    """id, base, added: arrays of (start, kind, end), by start and kind, of the plain findings and of those that the trees add.

    ``labelled`` (proposals' columns, label 0 or 1 and held_out) are candidates of known outcome; without it the trees
    learn from ``planted`` ones. Of added spans that overlap each other the best stays, and none that overlaps a plain one.
    Repeated rows are found alike, null ids are kept, empty tables give no rows; other columns are not read.
    """
    rows = stored(proposals(docs, id_col, text_col), "proposals")
    model = fit(features(stored(planted(docs, id_col, text_col), "findings") if labelled is None else labelled))
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    rows = rows.select("id", "sha", base.alias("base"), "wide")
    if model is None:
        return rows.select("id", "base", F.array().cast(rows.schema["base"].dataType).alias("added"))
    trees, least = model
    wide = features(rows.filter(F.size("wide") > 0).select("id", "sha", F.explode("wide").alias("c")).select("id", "sha", "c.*").distinct())
    level = F.element_at(F.array(*[F.lit(least.get(k, 2.0)) for k in range(len(KINDS))]), F.col("kind") + 1)
    chosen = stored(scored(wide, trees).filter(F.col("score") >= level).select("id", "sha", "start", "kind", "end", "score"), "chosen")
    keys = chosen.select(F.col("id").alias("chosen id"), F.col("sha").alias("chosen sha")).distinct()
    same = lambda name: F.col("id").eqNullSafe(F.col(f"{name} id")) & (F.col("sha") == F.col(f"{name} sha"))
    plain = rows.join(keys, same("chosen"), "left_semi").select("id", "sha", F.explode("base").alias("s")).select("id", "sha", "s.*", F.lit(None).cast("double").alias("score")).distinct()
    order = Window.partitionBy("id", "sha").orderBy("start", "kind", "end")
    upto = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = chosen.unionByName(plain).withColumn("opens", (F.col("start") >= F.coalesce(upto, F.lit(0))).cast("int"))
    runs = runs.withColumn("run", F.sum("opens").over(order))
    span = F.struct("start", "kind", "end")
    kept = runs.groupBy("id", "sha", "run").agg(F.count_if(F.col("score").isNull()).alias("plain"), F.max_by(span, F.struct("score", -F.col("start"), -F.col("kind"))).alias("s")).filter("plain = 0")
    added = kept.groupBy(F.col("id").alias("added id"), F.col("sha").alias("added sha")).agg(F.array_sort(F.collect_list("s")).alias("added"))
    return rows.join(added, same("added"), "left").select("id", "base", F.coalesce("added", F.array().cast(rows.schema["base"].dataType)).alias("added"))


def listed(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, found: Column) -> Column:
    """The text with each of the spans, which do not overlap, replaced by its kind in angle brackets."""
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    gap = lambda s, i: F.substring(text, (F.when(i > 0, F.get(found, i - 1)["end"]).otherwise(0) + 1).cast("int"), (s["start"] - F.when(i > 0, F.get(found, i - 1)["end"]).otherwise(0)).cast("int"))
    parts = F.transform(found, lambda s, i: F.concat(gap(s, i), F.element_at(names, s["kind"] + 1)))
    rest = F.substring(text, (F.coalesce(F.get(found, F.size(found) - 1)["end"], F.lit(0)) + 1).cast("int"), F.length(text))
    return F.concat(F.array_join(parts, ""), rest)


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find(read(spark, sf_dir, "documents"))
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    counts = [of_kind(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select(F.col("id").alias("doc_id"), *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"))
