"""Quality rules: line-first cleaning with built-in functions only.

Every line is judged on its own (punctuation, navigation, boilerplate),
failing lines are removed, and a document that loses too much of its text
is rejected. Base statistics of the whole input text come first: texts of
fewer than 20 words, or with over 30 % of their words in 8-word windows
that occur twice or more in the text, are rejected whatever their lines say.

Everything is computed row by row from arrays: no exchange, so copies and
hot sources cost nothing extra. Windows are compared by 64-bit hashes
within one text.

Defined results: a null text counts as empty: no words, rejected; lines
without a word are neither judged nor counted, and stay. Repeated rows give
repeated results. Columns of the input with any name are passed through
untouched by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spokewise.llm.common import BLANK_RUN, NOT_BLANK, let, words_of

WINDOW = 8            # words of a repetition window
MIN_WORDS = 20        # fewer: rejected
MAX_REPEAT = 30       # percent of words in repeated windows
MAX_SYMBOLS = 0.1     # symbols for each word of a line (its spaces and one)
MAX_SHOUTS = 0.3      # exclamation and question marks for each word of a line
MAX_LOST = 0.3        # share of the words' characters that cleaning may remove

SYMBOLS = r"[#*$%&|<>]"
SHOUTS = r"[!?]"
NAVIGATION = r"\|\s[^|]*\|\s"                             # two separators: a bar of links
STUTTER = r"(?<!\S)(\S++)(?:[ \t]++\1(?!\S)){4}"          # a word five times in a row
BOILERPLATE = (
    r"(?i)^\W*(all rights reserved|terms (of|and) (use|service|conditions)|privacy policy|cookie (policy|settings)"
    r"|we use cookies|accept (all )?cookies|click here|read more|share (this|on)|subscribe (now|to our)|sign (in|up)"
    r"|log ?in|lorem ipsum|enable javascript|javascript (is|must be)|skip to (main )?content|back to top"
    r"|powered by|follow us)\b.{0,80}$")


def _repeat_words(words: Column) -> Column:
    """Words in ``WINDOW``-word windows that occur at least twice, the first occurrence included."""

    def repeated(h: Column) -> Column:
        def covered(pairs: Column) -> Column:
            hits = F.filter(pairs, lambda e, i: F.coalesce(F.get(pairs, i - 1)["h"] == e["h"], F.lit(False))
                            | F.coalesce(F.get(pairs, i + 1)["h"] == e["h"], F.lit(False)))
            at = F.array_sort(F.transform(hits, lambda e: e["at"]))
            start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
            return F.aggregate(
                at, start,
                lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(WINDOW), x - a["last"])).alias("n")),
                lambda a: a["n"])

        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(pairs, covered))

    def windows(h: Column) -> Column:
        first = F.sequence(F.lit(0), F.size(h) - WINDOW)
        return let(F.transform(first, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])), repeated)

    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(
        let(F.transform(words, lambda w: F.xxhash64(w)), windows))


def base_stats(text: Column) -> Column:
    """Struct of the base statistics of a whole text."""
    text = F.coalesce(text, F.lit(""))

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"),
                        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        _repeat_words(w).cast("long").alias("n_repeat_words"))

    with_word = F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_BLANK))
    dup = let(with_word, lambda a: F.size(a) - F.size(F.array_distinct(a)))
    return let(let(words_of(text), of_words), lambda s: F.struct(
        s["n_words"].alias("n_words"),
        s["word_chars"].alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        dup.cast("long").alias("n_dup_lines"),
        s["n_repeat_words"].alias("n_repeat_words"),
        ((s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT * s["n_words"])).alias("base_failed")))


def line_fails(line: Column) -> Column:
    """True for a line with a word that breaks the punctuation, navigation or boilerplate rule."""

    def rules(gaps: Column) -> Column:
        n = gaps + 1
        # one mark alone (a heading, an exclamation) is no failure
        punctuation = ((F.regexp_count(line, F.lit(SYMBOLS)) > F.greatest(F.lit(1.0), MAX_SYMBOLS * n))
                       | (F.regexp_count(line, F.lit(SHOUTS)) > F.greatest(F.lit(1.0), MAX_SHOUTS * n)))
        return punctuation | line.rlike(NAVIGATION) | line.rlike(STUTTER) | line.rlike(BOILERPLATE)

    gaps = F.char_length(line) - F.char_length(F.replace(line, F.lit(" "), F.lit("")))
    return line.rlike(NOT_BLANK) & let(gaps, rules)


def judge(docs: DataFrame, text: str = "text", out: str = "quality") -> DataFrame:
    """``docs`` with a struct column ``out``: the base statistics, ``clean_text`` (lines that passed,
    joined as they were), ``lost_chars`` (characters of words in removed lines) and ``kept``."""
    src = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    def of_lines(lines: Column) -> Column:
        lost = F.array_join(F.transform(F.filter(lines, lambda x: x["fails"]), lambda x: x["line"]), "")
        return F.struct(
            F.array_join(F.transform(F.filter(lines, lambda x: ~x["fails"]), lambda x: x["line"]), "\n").alias("clean"),
            F.char_length(F.regexp_replace(lost, BLANK_RUN, "")).cast("long").alias("lost"))

    def verdict(s: Column) -> Column:
        b, c = s["base"], s["lines"]
        return F.struct(
            *[b[x].alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                      "base_failed")],
            c["clean"].alias("clean_text"), c["lost"].alias("lost_chars"),
            (~b["base_failed"] & (c["lost"] <= MAX_LOST * b["word_chars"])).alias("kept"))

    judged = F.transform(F.split(src, "\n"), lambda x: F.struct(x.alias("line"), line_fails(x).alias("fails")))
    both = F.struct(base_stats(src).alias("base"), let(judged, of_lines).alias("lines"))
    return docs.withColumn(out, let(both, verdict))


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without rejected documents; the text keeps the lines that passed."""
    # a generator, because a filter on a plain column would be pushed down and judge every text twice
    judged = judge(docs, text, "__judged").select(
        "*", F.explode(F.array("__judged")).alias("__quality")).drop("__judged")
    kept = judged.where(F.col("__quality.kept"))
    return kept.withColumn(text, F.col("__quality.clean_text")).drop("__quality")
