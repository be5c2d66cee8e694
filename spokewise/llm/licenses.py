"""Licence scan: a trained paragraph classifier with built-in functions only.

A paragraph is a line, or wrapped text: neighbouring lines with letters or
digits, all but the last of at most ``WRAP`` characters. Each line of wrapped
text is judged alone and all its lines together; where a line is confirmed,
the lines count, else the whole. A paragraph is normalised to lower-case words
without punctuation, digits as 0, and described by the 1- to 3-word runs it
contains. A sparse
multinomial logistic regression, fitted on the notices of
``license_templates`` with words left out and on lines without evidence,
gives the probability of every licence family and of the class "unknown"
(sentences about licences that name no family, and background lines). The
probabilities are calibrated by a temperature on variants that the fit did
not see, and the smallest probability for naming a family is the one at
which at most ``FALSE_SHARE`` of their unknown ones would be named. A named
family is confirmed by comparison with its templates: at least ``CONFIRM``
of the two-word runs of one of them must stand in the paragraph; otherwise
the paragraph is "unknown".

Only words of notices that few texts have (cue words) begin a look at a
document: every run of the model contains one, so a document without any
has no evidence and is skipped before its lines are taken apart (first by the
letters of cue words, one pass over the text). Scoring is
a join with the model (some thousand rows by construction, broadcast) and
one aggregation of the few paragraphs with evidence.

Whether a word of the notices is common is counted over all different texts,
without lines that a template matches, and each different line counts in one
text only: a notice that a large part of the corpus carries keeps its cue
words. The model depends on nothing else of the corpus: lines without a cue
word have no run of the model, so that all of them are the same example.

Defined results: null and blank texts have no paragraphs; a document
without evidence has family "none" and an empty list; ties between
families go to the name that comes first; rows with the same id and text
are counted once (sums are divided by the number of copies) and all get the
result; of a very long line only what the model and the templates know is
carried to the scoring; extra columns are ignored; empty
tables give an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spokewise.llm.common import let, written
from spokewise.llm.license_templates import TEMPLATES, UNKNOWN

FEWEST = 300           # a corpus of fewer different texts is taken to have so many
PLAIN = 600            # weight of lines without a cue word in the unknown class
VARIANTS = 12          # of each template; every fourth is kept for calibration
FALSE_SHARE = 0.01
CONFIRM = 0.6
COMMON = 0.1           # share of the different texts from which on a word is no cue
RUN = 3                # words of the longest run
WRAP = 100             # characters of a line that may go on in the next one
WHOLE = -1             # line number of all lines of a paragraph together
_SOFT = "\x0b"         # line ends inside a paragraph
_NONE, _UNKNOWN = "none", "unknown"


def normalised(text: Column) -> Column:
    """Lower-case words with single spaces; ASCII punctuation goes, every number is 0."""
    words = F.regexp_replace(F.lower(text), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " ")
    return F.trim(F.regexp_replace(words, r"[0-9]+", "0"))


def runs(words: Column, shortest: int = 1, longest: int = RUN) -> Column:
    """Distinct runs of neighbouring words, space-joined."""
    def of_length(n: int) -> Column:
        if n == 1:
            return words
        # single elements: a slice would copy the whole array for each run
        return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.concat_ws(
            " ", *[F.get(words, i + k) for k in range(n)]))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(*[of_length(n) for n in range(shortest, longest + 1)]))


@dataclass
class Model:
    """Weights by run (DataFrame: run, w), names of the classes, intercepts, temperature, least probability."""

    weights: DataFrame
    cues: list[str]
    classes: list[str]
    intercepts: list[float]
    temperature: float = 1.0
    least: float = 0.5


def _notices(spark: SparkSession) -> DataFrame:
    rows = [(f, n, t) for f, all_ in [*TEMPLATES.items(), (_UNKNOWN, UNKNOWN)] for n, t in enumerate(all_)]
    values = ", ".join("(" + ", ".join(["'" + f + "'", str(n), "'" + t.replace("'", "''") + "'"]) + ")" for f, n, t in rows)
    df = spark.sql(f"SELECT * FROM VALUES {values} AS t(family, n, text)")
    return df.withColumn("words", F.split(normalised(F.col("text")), " "))


def _examples(notices: DataFrame) -> DataFrame:
    """(family, variant, words): notices with words left out, and lines without a cue word as unknown. The latter
    have no run of the model whatever they say, so that all of the corpus are one example, repeated ``PLAIN`` times."""
    variant = notices.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
    # the plain notice, then one word in eight left out
    less = F.filter("words", lambda w, i: (F.col("variant") < 2)
                    | (F.pmod(F.xxhash64(w, i, F.col("variant")), F.lit(8)) > 0))
    plain = notices.sparkSession.range(PLAIN).select(
        F.lit(_UNKNOWN).alias("family"), (F.col("id") % VARIANTS).cast("int").alias("variant"),
        F.array().cast("array<string>").alias("words"))
    return variant.select("family", "variant", less.alias("words")).unionByName(plain)


def _alike(words: Column, templates: list[list[str]]) -> Column:
    """Whether a line has ``CONFIRM`` of the two-word runs of a template."""
    known = F.array(*map(F.lit, sorted({pair for t in templates for pair in t})))
    listed = F.array(*[F.array(*map(F.lit, t)) for t in templates])
    fewest = min(CONFIRM * len(t) for t in templates)
    return let(F.array_intersect(runs(words, 2, 2), known), lambda pairs: F.when(
        F.size(pairs) >= fewest, F.exists(listed, lambda t: F.size(F.array_intersect(t, pairs)) >= CONFIRM * F.size(t))
    ).otherwise(False))


def _anchors(templates: list[list[str]]) -> set[str]:
    """Words (long ones, as few texts have them) of which every line like a template has one: without them, fewer
    than ``CONFIRM`` of its runs are left."""
    chosen: set[str] = set()
    for t in templates:
        words = sorted({w for pair in t for w in pair.split(" ")}, key=lambda w: (len(w), w), reverse=True)
        while sum(not chosen & set(pair.split(" ")) for pair in t) >= CONFIRM * len(t):
            chosen.add(next(w for w in words if w not in chosen))
    return chosen


def _common(docs: DataFrame, text: Column, listed: list[str], templates: list[list[str]]) -> set[str]:
    """Those of the listed words that stand in many of all different texts; lines like a template and repeated
    lines don't count. A line travels as its hash and a bit for each listed word."""
    total = docs.select(F.xxhash64(text).alias("t")).agg(F.count_distinct("t")).first()[0]
    lines = docs.select(F.xxhash64(text).alias("t"), F.explode(F.transform(
        F.split(text, "\n"), lambda line: F.split(normalised(line), " "))).alias("words"))
    some = F.arrays_overlap("words", F.array(*map(F.lit, sorted(_anchors(templates)))))
    lines = lines.where(~F.when(some, _alike(F.col("words"), templates)).otherwise(False))
    each = lines.select("t", F.xxhash64("words").alias("line"), F.explode("words").alias("word"))
    bits = [f"bits{k}" for k in range(0, len(listed), 62)]
    rows = ", ".join(f"('{w}', {', '.join(f'{1 << k % 62 if k // 62 == j else 0}L' for j in range(len(bits)))})"
                     for k, w in enumerate(listed))
    place = docs.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t(word, {', '.join(bits)})")
    # a line counts in the text with the smallest hash
    lines = each.join(F.broadcast(place), "word").groupBy("line").agg(
        F.min("t").alias("t"), *[F.bit_or(b).alias(b) for b in bits])
    texts = lines.groupBy("t").agg(*[F.bit_or(b).alias(b) for b in bits])
    counts = texts.agg(*[F.sum(F.getbit(bits[k // 62], F.lit(k % 62)).cast("long")) for k in range(len(listed))]).first()
    return {w for w, n in zip(listed, counts) if (n or 0) > COMMON * max(total, FEWEST)}


def train(docs: DataFrame, text: str = "text") -> Model:
    """Fit the classifier on the notices; which of their words are cues is counted over all of ``docs``."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizerModel

    spark = docs.sparkSession
    notices = _notices(spark)
    rows = notices.select("family", "words", runs(F.col("words"), 2, 2).alias("pairs")).collect()   # fixed notices
    words = sorted({w for r in rows for w in r.words if len(w) > 1})
    common = _common(docs, F.coalesce(F.col(f"`{text}`"), F.lit("")), words,
                     [r.pairs for r in rows if r.family != _UNKNOWN])
    cues = [w for w in words if w not in common]
    if not cues:
        return Model(_literal(spark, [""], [[0.0]]), [], [_UNKNOWN], [0.0])
    listed = F.array(*map(F.lit, cues))
    known = notices.select(F.explode(runs(F.col("words"))).alias("run")).distinct()
    vocabulary = sorted(r.run for r in known.where(F.arrays_overlap(F.split("run", " "), listed)).collect())
    classes = sorted([*TEMPLATES, _UNKNOWN])
    number = F.array_position(F.array(*map(F.lit, classes)), F.col("family")) - 1
    rows = written(_examples(notices).select(
        number.cast("double").alias("label"), "variant", runs(F.col("words")).alias("runs")), "licence-examples")
    counts = CountVectorizerModel.from_vocabulary(vocabulary, "runs", "features")
    counts = counts.setBinary(True)
    vectors = counts.transform(rows)
    held = F.col("variant") % 4 == 2
    fitted = LogisticRegression(family="multinomial", regParam=0.002, maxIter=80).fit(vectors.where(~held))
    # classes of the fit are the labels 0 .. n - 1
    table = fitted.coefficientMatrix.toArray().T.tolist()
    model = Model(_literal(spark, vocabulary, table), cues, classes, fitted.interceptVector.toArray().tolist())
    seen = [(int(r.label), [float(x) for x in r.rawPrediction]) for r in
            fitted.transform(vectors.where(held)).select("label", "rawPrediction").collect()]
    _calibrate(model, seen)
    return model


def _literal(spark: SparkSession, vocabulary: list[str], table: list[list[float]]) -> DataFrame:
    """The weights as rows of a SQL relation."""
    rows = ", ".join(f"('{run}', array({', '.join(f'{x:.6g}D' for x in w)}))" for run, w in zip(vocabulary, table))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(run, w)")


def _softmax(z: list[float], temperature: float) -> list[float]:
    top = max(z)
    e = [math.exp((x - top) / temperature) for x in z]
    return [x / sum(e) for x in e]


def _calibrate(model: Model, seen: list[tuple[int, list[float]]]) -> None:
    """Temperature of least log loss on the held variants, then the least probability of a named family."""
    if not seen:
        return
    grid = [0.25 * 1.15 ** k for k in range(24)]
    model.temperature = min(grid, key=lambda t: -sum(math.log(max(_softmax(z, t)[y], 1e-12)) for y, z in seen))
    unknown = model.classes.index(_UNKNOWN)
    named = sorted((max(x for k, x in enumerate(_softmax(z, model.temperature)) if k != unknown)
                    for y, z in seen if y == unknown), reverse=True)
    if named:
        model.least = min(0.9, max(0.5, named[int(FALSE_SHARE * len(named))] + 1e-9))


def _best(p: Column, classes: list[str]) -> Column:
    """(p, family) of the most probable class; ties go to the name that comes first."""
    each = F.array(*[F.struct(F.get(p, k).alias("p"), F.lit(c).alias("family")) for k, c in enumerate(classes)])
    return F.aggregate(each, F.struct(F.lit(-1.0).alias("p"), F.lit("").alias("family")),
                       lambda a, x: F.when(x["p"] > a["p"], x).otherwise(a))


def _has_cue(text: Column, cues: list[str]) -> Column:
    """Whether the text has a cue word; the letters of cue words, found in one pass, rule most texts out."""
    exact = F.arrays_overlap(F.split(normalised(text), " "), F.array(*map(F.lit, cues)))
    letters = sorted({max(c.split("0"), key=len) for c in cues})
    if "" in letters:  # a number is a cue
        return exact
    pieces = F.split(F.lower(text), r"[\x00-\x60\x7B-\x7F]+")
    return F.arrays_overlap(pieces, F.array(*map(F.lit, letters))) & exact


def _paragraphs(text: Column) -> Column:
    """The paragraphs of a text, with ``_SOFT`` between their lines."""
    soft = rf"(?dm)^(?=[^\n]{{1,{WRAP}}}\n)([^\n]*[A-Za-z0-9][^\n]*)\n(?=[^\n]*[A-Za-z0-9])"
    return F.split(F.regexp_replace(F.replace(text, F.lit(_SOFT), F.lit(" ")), soft, f"$1{_SOFT}"), "\n")


def scan(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, row, paragraph, line, family, probability) of the paragraphs with evidence; row is the text's
    hash, line the number in the paragraph (``WHOLE``: all of wrapped text), family a confirmed one or "unknown"."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    src = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(body).alias("row"), body.alias("text"))
    cues = F.array(*map(F.lit, model.cues)) if model.cues else F.array().cast("array<string>")
    src = src.where(_has_cue(F.col("text"), model.cues) if model.cues else F.lit(False))
    blocks = src.select("doc_id", "row", F.posexplode(_paragraphs(F.col("text"))).alias("paragraph", "block"))
    each = F.transform(F.split("block", _SOFT), lambda x, k: F.struct(k.alias("line"), x.alias("text")))
    whole = F.array(F.struct(F.lit(WHOLE).alias("line"), F.col("block").alias("text")))
    units = F.when(F.contains("block", F.lit(_SOFT)), F.concat(each, whole)).otherwise(each)
    lines = blocks.select("doc_id", "row", "paragraph", F.inline(units).alias("line", "unit"))
    lines = lines.select("doc_id", "row", "paragraph", "line", F.split(normalised(F.col("unit")), " ").alias("words"))
    lines = lines.where(F.arrays_overlap("words", cues))
    templates = written(_notices(docs.sparkSession).where(F.col("family") != _UNKNOWN).select(
        "family", runs(F.col("words"), 2, 2).alias("tpairs")), "licence-templates")
    known = F.array(*[F.lit(r.pair) for r in templates.select(
        F.explode("tpairs").alias("pair")).distinct().orderBy("pair").collect()])  # of the fixed notices
    pair = F.array_intersect(known, let(F.col("words"), lambda w: runs(w, 2, 2)))
    # an empty run for each copy of a paragraph, which counts the copies
    # a select of its own: beside the explode, the pairs would be made again for each run
    lines = lines.withColumn("pairs", pair)
    seen = lines.select("doc_id", "row", "paragraph", "line", "pairs",
                        F.explode(F.concat(let(F.col("words"), lambda w: runs(w)), F.array(F.lit("")))).alias("run"))
    n = len(model.classes)
    none = docs.sparkSession.range(1).select(F.lit("").alias("run"), F.array_repeat(F.lit(0.0), n).alias("w"))
    copies = F.sum((F.col("run") == "").cast("long"))
    # the pairs ride along; all rows of a paragraph have the same
    sums = seen.join(F.broadcast(model.weights.where("run != ''").unionByName(none)), "run").groupBy(
        "doc_id", "row", "paragraph", "line").agg(
        F.array(*[F.sum(F.get("w", k)) / copies for k in range(n)]).alias("z"), F.first("pairs").alias("pairs"))
    z = F.array(*[(F.get("z", k) + F.lit(model.intercepts[k])) / F.lit(model.temperature) for k in range(n)])
    top = F.array_max("s")
    e = F.transform("s", lambda x: F.exp(x - top))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    scored = sums.withColumn("s", z).withColumn("e", e).withColumn("p", F.transform("e", lambda x: x / total))
    scored = scored.withColumn("best", _best(F.col("p"), model.classes))
    kinds = F.broadcast(templates.groupBy("family").agg(F.collect_list("tpairs").alias("templates")))
    checked = scored.withColumn("family", F.col("best.family")).join(kinds, "family", "left")
    alike = F.array_max(F.transform("templates", lambda t: F.size(F.array_intersect(t, F.col("pairs"))) / F.size(t)))
    sure = (F.col("family") != _UNKNOWN) & (F.col("best.p") >= model.least) & (F.coalesce(alike, F.lit(0.0)) >= CONFIRM)
    found = checked.select("doc_id", "row", "paragraph", "line", F.when(sure, F.col("family")).otherwise(
        _UNKNOWN).alias("family"), F.col("best.p").alias("probability"))
    # of wrapped text either the lines count or the whole
    paragraph = Window.partitionBy("doc_id", "row", "paragraph")
    named, together = F.col("family") != _UNKNOWN, F.col("line") == WHOLE
    found = found.withColumn("by_line", F.max(named & ~together).over(paragraph)).withColumn(
        "by_whole", F.max(named & together).over(paragraph))
    return found.where(F.when(together, F.col("by_whole") & ~F.col("by_line")).otherwise(
        F.col("by_line") | ~F.col("by_whole"))).drop("by_line", "by_whole")


def families(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, family, families, n_paragraphs) per row of ``docs``: the first confirmed family in the
    text ("unknown": only unconfirmed evidence, "none": no evidence), all of them, and how many paragraphs
    (lines of wrapped text each) name one."""
    found = scan(docs, model, text, doc_id).groupBy("doc_id", "row").agg(
        F.min(F.when(F.col("family") != _UNKNOWN, F.struct("paragraph", "line", "family"))).alias("first"),
        F.sort_array(F.collect_set(F.when(F.col("family") != _UNKNOWN, F.col("family")))).alias("families"),
        F.count(F.when(F.col("family") != _UNKNOWN, 1)).alias("n_paragraphs"))
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    each = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(body).alias("row"))
    found = found.select(F.col("doc_id").alias("id2"), F.col("row").alias("row2"), "first", "families", "n_paragraphs",
                         F.lit(True).alias("seen"))
    both = each.join(found, F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("row") == F.col("row2")), "left")
    return both.select(
        "doc_id", F.coalesce("first.family", F.when(F.col("seen"), _UNKNOWN), F.lit(_NONE)).alias("family"),
        F.coalesce("families", F.array().cast("array<string>")).alias("families"),
        F.coalesce("n_paragraphs", F.lit(0)).cast("long").alias("n_paragraphs"))
