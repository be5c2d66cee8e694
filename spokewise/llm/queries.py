"""Registered queries of the operators: thin digests over each operator's own output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokewise.llm import (
    bpe, decontamination, hard_negatives, licenses, line_dedup, pitman_yor, quality_gam, quality_rules,
    simhash_bktree, substring_dedup, toxicity, warc, whitening,
)
from spokewise.llm.common import held_out, table

Builder = Callable[[SparkSession, str], DataFrame]


def byte_bpe_path() -> str:
    """Place of the public tokenizer file that the contract names."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licenses.families(docs, licenses.train(docs))


def op2_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_gam.train(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    return quality_gam.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_digests(table(spark, sf_dir, "pages"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=20)
    return cut.select("doc_id", "n_words", "n_removed", substring_dedup.kept_digest().alias("kept_sha256"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_bktree.components(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", simhash_bktree.hex_fingerprint().alias("fingerprint"), "component_id")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), byte_bpe_path())


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.summary(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    return toxicity.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), out="q")
    return q.select("doc_id", "q.n_words", "q.word_chars", "q.n_symbols", "q.n_dup_lines", "q.n_repeat_words",
                    "q.base_failed", "q.kept")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` is null where the exact number does not fit a long."""
    out = whitening.whiten(table(spark, sf_dir, "embeddings"), components=8, scale=1024, offset=100_000)
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mine(rows, F.col("id") % 100 == 0, positives=5, negatives=10, low=30, high=90, scale=256)


def op13_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``held_out`` rows (remainder 1) are scored only; the others are learned from, and scored too."""
    held = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % 5 == 1
    return pitman_yor.score(table(spark, sf_dir, "documents"), held)


QUERIES: dict[str, Builder] = {
    "op1_licenses": op1_licenses,
    "op2_quality_gam": op2_quality_gam,
    "op3_warc": op3_warc,
    "op4_decontamination": op4_decontamination,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_simhash": op6_simhash,
    "op7_bpe": op7_bpe,
    "op8_line_dedup": op8_line_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_quality_rules": op10_quality_rules,
    "op11_whitening": op11_whitening,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_pitman_yor": op13_pitman_yor,
}

ORACLE_SQL: dict[str, str] = {
    "op3_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
             d AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS digest FROM p),
             m AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest) END AS last_id FROM d)
        SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
               CASE WHEN page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id < last_id THEN last_id END AS refers_to
        FROM m""",
    "op5_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
             windows AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS k
                         FROM d, unnest(range(1, len(w) - 18)) AS t(s)),
             later AS (SELECT doc_id, s FROM windows QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, s) > 1),
             gone AS (SELECT DISTINCT doc_id, s + o AS p FROM later, range(0, 20) AS t(o)),
             words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
             kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n
                      FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op10_quality_rules": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
                          regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
             windows AS (SELECT doc_id, s, array_to_string(w[s:s + 7], ' ') AS k
                         FROM d, unnest(range(1, len(w) - 6)) AS t(s)),
             twice AS (SELECT doc_id, s FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
             repeated AS (SELECT doc_id, count(DISTINCT s + o) AS n FROM twice, range(0, 8) AS t(o) GROUP BY doc_id),
             lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
             judged AS (SELECT doc_id, line, length(line) - length(replace(line, ' ', '')) + 1 AS n,
                               length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
                               regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS v
                        FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
             failing AS (SELECT *, len(regexp_extract_all(line, '[#*$%&|<>]')) > greatest(1.0::DOUBLE, 0.1::DOUBLE * n)
                                OR len(regexp_extract_all(line, '[!?]')) > greatest(1.0::DOUBLE, 0.3::DOUBLE * n)
                                OR regexp_matches(line, '@NAVIGATION@') OR regexp_matches(line, '@BOILERPLATE@')
                                OR len(list_filter(range(1, len(v) - 3), lambda i: v[i] = v[i + 1] AND v[i] = v[i + 2]
                                                   AND v[i] = v[i + 3] AND v[i] = v[i + 4])) > 0 AS fails
                         FROM judged),
             by_doc AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dup, sum(chars) FILTER (WHERE fails) AS lost
                        FROM failing GROUP BY doc_id),
             base AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
                             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
                             coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
                             coalesce(lost, 0) AS lost,
                             len(w) < 20 OR 100 * coalesce(r.n, 0) > 30 * len(w) AS base_failed
                      FROM d LEFT JOIN by_doc USING (doc_id) LEFT JOIN repeated r USING (doc_id))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND lost <= 0.3::DOUBLE * word_chars AS kept
        FROM base""".replace("@NAVIGATION@", quality_rules.NAVIGATION).replace(
        "@BOILERPLATE@", quality_rules.BOILERPLATE),
    "op12_hard_negatives": """
        WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
                   FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
                     AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
             pairs AS (SELECT a.id AS anchor_id, b.id AS other_id, a.label = b.label AS same,
                              list_dot_product(a.x, b.x)::BIGINT AS score
                       FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 100 = 0),
             near AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
                      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id
                                                          ORDER BY score DESC, other_id)::INTEGER AS rank,
               other_id AS negative_id, positive_score, score AS negative_score
        FROM near JOIN pairs USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 10""",
}
