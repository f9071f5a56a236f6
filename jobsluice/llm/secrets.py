"""Secret scans: long tokens, judged by a random forest that removes false positives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobsluice.llm.common import SPACES, read, stored, text_of

#: Fewest characters of a candidate.
SHORTEST = 20
#: Three-letter stretches of the corpus that make up the dictionary: the most frequent so many.
DICTIONARY = 3000
#: Bound of the findings of each label that the forest is fitted on, and of the findings planted where none are given.
SAMPLE_ROWS, PLANTED = 8000, 8000
#: Digits of a digest by which rows are counted, which makes a million counts at most.
DIGITS = 5
#: One planted finding in so many is kept from the forest, to measure it.
HELD_OUT = 4
TREES, DEPTH, SEED = 30, 6, 17
#: A token: three or more dotted parts, as of web tokens, or one long stretch with its padding.
CORE = r"(?:[A-Za-z0-9_\-]{8,}(?:\.[A-Za-z0-9_\-]{8,}){2,}|[A-Za-z0-9_/+\-]{20,}={0,2})"
#: Words near a candidate that speak for a secret, and such that speak against one.
FOR = r"(?i)(secret|token|passw|pwd|credential|auth|api.?key|access.?key|private)"
AGAINST = r"(?i)(example|sample|dummy|placeholder|changeme|sha|commit|checksum|digest|uuid|hash)"
#: The same for the parts of a document's path.
QUIET_PATH = r"(?i)(^|[/_.\-])(test|tests|example|examples|fixture|fixtures|doc|docs|vendor|sample)($|[/_.\-])"
EIGHT_WORDS = rf"^[{SPACES}]*+[^{SPACES}]++(?:[{SPACES}]++[^{SPACES}]++){{7}}"
FEATURES = ["length", "transitions", "digits", "uppers", "distinct", "hexadecimal", "coverage", "depth", "quiet_path", "assigned", "quoted", "named", "denied"]


def _words(text: Column) -> Column:
    return F.split(text, f"[{SPACES}]+")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """id, pos, place, word, core, before, after, path: the long tokens of all words, with the words' neighbours.

    ``pos`` counts the words of the text from 0, ``place`` the long tokens of the word. Every place of a token is a
    candidate of its own. Null and empty texts have none; a null path is empty. Of a word with several tokens, ``word``
    is the token's own part: from the token before it to the last sign that closes it, so that the next one's name does not count.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"), _words(text_of(text_col)).alias("w"))
    rows = rows.select("id", "path", "w", F.posexplode_outer("w").alias("pos", "word")).filter((F.length("word") >= SHORTEST) & F.col("word").rlike(CORE))
    near = lambda first, n: F.array_join(F.slice("w", first, n), " ")
    before = F.when(F.col("pos") > 0, near(F.greatest(F.lit(1), F.col("pos") - 2), F.least(F.lit(3), F.col("pos")))).otherwise("")
    return _tokens(rows.select("id", "pos", "word", before.alias("before"), near(F.col("pos") + 2, F.lit(2)).alias("after"), "path"))


def _tokens(rows: DataFrame, *more: str) -> DataFrame:
    """The long tokens of ``word``, each with its place; see candidates."""
    tokens, gaps = F.regexp_extract_all("word", F.lit(CORE), F.lit(0)), F.split("word", CORE)
    rows = rows.select("id", "path", "pos", gaps.alias("gaps"), "before", "after", *more, F.posexplode(tokens).alias("place", "core"))
    rest = F.get("gaps", F.col("place") + 1)
    close = F.when(F.col("place") + 2 < F.size("gaps"), F.regexp_extract(rest, "^[^A-Za-z0-9]*", 0)).otherwise(rest)
    return rows.select("id", "pos", "place", F.concat(F.get("gaps", F.col("place")), "core", close).alias("word"), "core", "before", "after", "path", *more)


def first_by_digest(rows: DataFrame, n: int, work: Callable[[DataFrame], DataFrame] = lambda few: few) -> DataFrame:
    """The first n rows in the order of the hexadecimal digest ``h`` and id, after ``work``, which keeps h and id.

    Rows are counted by the first DIGITS digits before, the counts are summed up by two digits and then within the block
    of the n-th row, and only rows up to it are worked on and sorted: otherwise each partition would send n rows to one task.
    """
    def reached(counts: DataFrame, above: int) -> tuple[str, int] | None:
        """The start at which ``above`` rows are reached, and the rows before it; ``counts`` are a few thousand at most."""
        upto = F.sum("n").over(Window.orderBy("start").rowsBetween(Window.unboundedPreceding, 0))
        return counts.withColumn("upto", upto).filter(F.col("upto") >= above).orderBy("start").select("start", F.col("upto") - F.col("n")).first()

    counts = stored(rows.groupBy(F.left("h", F.lit(DIGITS)).alias("start")).agg(F.count(F.lit(1)).alias("n")), "digests")
    block = reached(counts.groupBy(F.left("start", F.lit(2)).alias("start")).agg(F.sum("n").alias("n")), n)
    last = block and reached(counts.filter(F.col("start").startswith(block[0])), n - block[1])
    few = rows if last is None else rows.filter(F.left("h", F.lit(DIGITS)) <= last[0])
    return work(few).orderBy("h", "id").limit(n)


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """Candidates whose outcome is known because they were put there: candidates' columns, label and held_out.

    Of up to PLANTED texts of eight words or more, in the order of a hash of the row, three words before a place and two
    after it are the surroundings; no other text is split into words; between them stands a random token (label 1), with or without a name, or what is often
    mistaken for one (label 0): words run together, hashes of commits and checksums, identifiers, placeholders under a
    secret's name. Labels tell how a token was made, which no input of the forest knows.
    """
    def surroundings(few: DataFrame) -> DataFrame:
        few = few.withColumn("w", _words(F.col("text")))
        at = F.pmod(F.xxhash64("id", F.lit("place"), F.size("w")), F.size("w") - 7).cast("int")
        cut = lambda first, n: F.transform(F.slice("w", first, F.lit(n)), lambda x: F.left(x, F.lit(100)))
        return few.select("id", "path", "h", cut(at + 1, 3).alias("b"), cut(at + 4, 2).alias("a"), cut(at + 4, 4).alias("joined"))

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"), text_of(text_col).alias("text")).filter(F.col("text").rlike(EIGHT_WORDS))
    rows = rows.withColumn("h", F.sha2(F.concat_ws(" ", F.lit("planted"), F.col("id").cast("string"), "path", F.xxhash64("text").cast("string")), 256))
    rows = first_by_digest(rows, PLANTED, surroundings)
    pick = lambda n, k: F.pmod(F.xxhash64("h", F.lit(k)), F.lit(n)) + 1
    one_of = lambda k, *words: F.element_at(F.array(*map(F.lit, words)), pick(len(words), k).cast("int"))
    hexa, packed = F.left("h", 8 * (pick(3, 1) + 2)), F.base64(F.unhex("h"))
    plain = F.regexp_replace(packed, "[^A-Za-z0-9]", "")
    key = F.concat(F.lit("AK"), F.upper(F.left(plain, F.lit(22))))
    web = F.concat(F.lit("eyJ"), F.left(plain, F.lit(14)), F.lit("."), F.substring(plain, 15, 12), F.lit("."), F.substring(plain, 20, 18))
    random = F.element_at(F.array(F.left("h", F.lit(40)), packed, plain, key, web, hexa), pick(6, 2).cast("int"))
    joined = F.lower(F.regexp_replace(F.concat_ws("-", "joined"), r"[^A-Za-z0-9_/\-]", ""))
    joined = F.when(pick(2, 4) == 1, F.regexp_replace(joined, "-", "")).otherwise(F.call_function("replace", joined, F.lit("-"), one_of(3, "-", "_", "/")))
    joined = F.rpad(joined, F.greatest(F.lit(20), F.length(joined)), joined)
    uuid = F.regexp_replace(F.left("h", F.lit(32)), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-")
    name = one_of(5, "token", "password", "api_key", "secret", "auth_token", "credential", "private_key")
    quote = one_of(6, "", '"', "'")
    quoted = lambda x: F.concat(quote, x, quote, one_of(7, "", ",", ";"))
    made = lambda label, word, *before: F.struct(F.lit(label).alias("label"), F.slice(F.concat("b", F.array(*before)), -3, 3).alias("before"), word.alias("word"))
    holder = F.concat(one_of(8, "your", "my", "example", "some"), F.lit("-"), F.regexp_replace(name, "_", "-"), one_of(9, "-goes-here", "-for-testing-only", "-placeholder-value"))
    kinds = [
        made(1.0, quoted(random), name, F.lit("=")),
        made(1.0, quoted(random), F.concat(name, F.lit(":"))),
        made(1.0, F.concat(name, F.lit("="), quoted(random))),
        made(1.0, quoted(random)),
        made(0.0, quoted(joined)),
        made(0.0, quoted(joined), one_of(10, "see", "file", "path", "in"), one_of(11, "=", ":", "the")),
        made(0.0, F.left("h", F.lit(40)), one_of(12, "commit", "sha", "checksum", "digest")),
        made(0.0, quoted(uuid), one_of(13, "uuid", "id", "request")),
        made(0.0, quoted(holder), name, F.lit("=")),
    ]
    rows = rows.withColumn("p", F.element_at(F.array(*kinds), pick(len(kinds), 14).cast("int")))
    rows = rows.select("id", "path", F.lit(0).alias("pos"), "p.word", F.array_join("p.before", " ").alias("before"), F.array_join("a", " ").alias("after"), "p.label", (pick(HELD_OUT, 15) == 1).alias("held_out"))
    return _tokens(rows, "label", "held_out")


def dictionary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """part: the most frequent three-letter stretches in the words of all texts, DICTIONARY at most."""
    words = docs.select(F.explode_outer(_words(F.lower(text_of(text_col)))).alias("word")).filter(F.col("word").rlike(r"^\p{L}{3,15}$"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    parts = counts.select("n", F.explode(_stretches(F.col("word"))).alias("part")).groupBy("part").agg(F.sum("n").alias("n"))
    return parts.orderBy(F.desc("n"), "part").limit(DICTIONARY).select("part")


def _stretches(word: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(word) - 2)), lambda i: F.substring(word, i, F.lit(3)))


def features(found: DataFrame, known: DataFrame) -> DataFrame:
    """Adds the forest's inputs to candidates; ``known`` is the dictionary, of a bounded size.

    coverage is the share of the core's three-letter stretches that the dictionary has.
    """
    size = F.length("core").cast("double")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace("core", "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    share = lambda pattern: (size - F.length(F.regexp_replace("core", pattern, ""))) / size
    rows = found.select(
        "*",
        size.alias("length"),
        ((F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1) / size).alias("transitions"),
        share("[0-9]").alias("digits"),
        share("[A-Z]").alias("uppers"),
        (F.size(F.array_distinct(F.split("core", ""))) / size).alias("distinct"),
        F.col("core").rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double").alias("hexadecimal"),
        F.size(F.split("path", "/")).cast("double").alias("depth"),
        F.col("path").rlike(QUIET_PATH).cast("double").alias("quiet_path"),
        (F.col("before").rlike(r"[=:]$") | F.col("word").rlike(rf"[=:][\"']?{CORE}")).cast("double").alias("assigned"),
        F.col("word").rlike(r"^[^A-Za-z0-9]*[\"']|[\"'][^A-Za-z0-9]*$").cast("double").alias("quoted"),
        (F.col("before").rlike(FOR) | F.col("word").rlike(FOR)).cast("double").alias("named"),
        (F.col("before").rlike(AGAINST) | F.col("after").rlike(AGAINST)).cast("double").alias("denied"),
    )
    cores = rows.select("core").distinct().select("core", F.explode(_stretches(F.lower("core"))).alias("part"))
    listed = F.broadcast(known.select("part", F.lit(1).alias("in")))
    covered = cores.join(listed, "part", "left").groupBy("core").agg((F.count("in") / F.count(F.lit(1))).alias("coverage"))
    return rows.join(covered, "core")


def fit(labelled: DataFrame) -> RandomForestClassificationModel | None:
    """A forest fitted to labelled findings (features and label 0 or 1), SAMPLE_ROWS of each label in the order of a hash.

    Without findings of both labels there is nothing to fit, and None.
    """
    dealt = labelled.withColumn("h", F.sha2(F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("id", "pos", "place", "core")]), 256))
    sample = [first_by_digest(dealt.filter(F.col("label") == y), SAMPLE_ROWS).select(*FEATURES, "label") for y in (0, 1)]
    rows = stored(sample[0].union(sample[1]), "findings")
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(featuresCol="inputs", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt")
    return forest.fit(_assembled(rows))


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="inputs").transform(rows)


def judge(rows: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """id, pos, place, core, score, secret for each candidate; without a model every candidate stays, with score null."""
    if model is None:
        return rows.select("id", "pos", "place", "core", F.lit(None).cast("double").alias("score"), F.lit(True).alias("secret"))
    scored = model.transform(_assembled(rows)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("id", "pos", "place", "core", "score", (F.col("score") >= 0.5).alias("secret"))


def quality(judged: DataFrame, label: str = "label") -> DataFrame:
    """One row: precision and recall of ``secret`` against a label of 1 or 0; null where there is nothing to divide by."""
    hit = F.col("secret") & (F.col(label) == 1)
    ratio = lambda a, b: F.when(b > 0, a / b)
    return judged.agg(ratio(F.count_if(hit), F.count_if("secret")).alias("precision"), ratio(F.count_if(hit), F.count_if(F.col(label) == 1)).alias("recall"))


def scan(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """id, pos, place, core, score, secret: all candidates of the whole texts with the forest's verdict.

    ``labelled`` (id, pos, place, label) are findings with known outcome; without it the forest learns from ``planted``
    ones. Where ``labelled`` has no place, it labels a word's first token. A key of several lines is a candidate in each.
    Repeated rows give repeated findings, null ids are kept, empty tables give no rows; other columns are not read.
    """
    known = stored(dictionary(docs, text_col), "dictionary")
    rows = stored(features(candidates(docs, id_col, text_col, path_col), known), "candidates")
    if labelled is None:
        outcomes = features(stored(planted(docs, id_col, text_col, path_col), "planted"), known).filter(~F.col("held_out"))
    else:
        place = F.col("place") if "place" in labelled.columns else F.lit(0).alias("place")
        given = labelled.select("id", "pos", place, F.col("label").cast("double").alias("label")).dropDuplicates(["id", "pos", "place"])
        outcomes = rows.join(given, ["id", "pos", "place"])
    return judge(rows, fit(stored(outcomes, "outcomes")))


def held_out_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """Precision and recall of the forest that ``scan`` would use, on the planted findings that it never saw."""
    known = stored(dictionary(docs, text_col), "dictionary")
    rows = stored(features(stored(planted(docs, id_col, text_col, path_col), "planted"), known), "features")
    model = fit(rows.filter(~F.col("held_out")))
    held = rows.filter("held_out")
    return quality(judge(held, model).join(held.select("id", "pos", "place", "core", "label").distinct(), ["id", "pos", "place", "core"]))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(read(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "pos", "place", F.col("core").alias("token"), "score", "secret")
