import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spokewise.llm import licenses, quality_gam, toxicity, wordstream
from spokewise.llm.common import held_out, one_text_an_id
from spokewise.llm.queries import op1_licenses, op2_quality_gam, op9_toxicity
from tests.llm.edge import ROWS, edge_docs, words

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_of_several_texts_of_an_id_one_is_chosen_in_any_order(spark):
    rows = [(i, t, i % 2) for i in range(20) for t in (f"text {i}", f"other {i}", None, f"text {i}")]
    ddl = "doc_id long, text string, y int"
    a, b = (sorted(one_text_an_id(spark.createDataFrame(x, ddl).repartition(n), "y").collect())
            for n, x in ((1, rows), (5, rows[::-1])))
    assert a == b and len(a) == 20 and all(r.text is not None and r.y == r.doc_id % 2 for r in a)


def test_word_stream_matches_split():
    texts = ["a b", None, "", " x ", "é\tü\n\nz", "same same", "ab", "a", "b" * 100] * 20
    seen = {}
    for block in (1, 7, 1 << 20):
        rows = []
        for lo, hi, w in wordstream.blocks(pa.array(texts), block=block):
            for t in range(hi - lo):
                k = range(w.first[t], w.first[t + 1])
                rows.append([bytes(w.data[w.start[x]:w.stop[x]]).decode() for x in k])
                for x in k:
                    key = bytes(w.data[w.start[x]:w.stop[x]])
                    assert seen.setdefault(key, int(w.hashes[x])) == int(w.hashes[x])
        assert rows == [words(t) for t in texts]
    assert len(set(seen.values())) == len(seen)


def test_held_out_is_crc32(spark):
    ids = [0, 1, 5, -7, 10**15, None]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", held_out(F.col("doc_id"))).collect()
    assert [r[1] for r in got] == [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0 for i in ids]


# ---- quality --------------------------------------------------------------
def accuracy(spark, query, label, sf=SF):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = query(spark, sf).join(labels, "doc_id").where("held_out").select("predicted", label).collect()
    return sum(r[0] == r[1] for r in rows) / len(rows)


def test_quality_held_out_accuracy(spark):
    assert accuracy(spark, op2_quality_gam, "quality") >= 0.95


def test_quality_model_learns_single_features_and_pairs():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(quality_gam.FEATURES))).astype(np.float32)
    y = ((x[:, 0] > 0.75) ^ (x[:, 3] > 0.5)).astype(float)
    m = quality_gam.fit(x[:3000], y[:3000])
    assert ((m.scores(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95
    assert {0, 3} in [{i, j} for i, j, _ in m.pairs]


def test_quality_does_not_use_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    wrong = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality_gam.train(docs, x, ~held_out(F.col("doc_id"))) for x in (labels, wrong))
    assert all((p == q).all() for p, q in zip(a.tables, b.tables))


@pytest.mark.parametrize("labels", [[], [(1, 1, 1), (None, 0, 1), (3, None, None)], [(1, 1, 0), (5, 0, 1), (1, 0, 1)]])
def test_classifiers_on_edge_rows(spark, labels):
    docs = edge_docs(spark)
    table = spark.createDataFrame([(*r, "a", 1) for r in labels], "doc_id long, quality int, toxic int, text string, y int")
    for out in (quality_gam.score(docs, quality_gam.train(docs, table, F.lit(True))),
                toxicity.score(docs, toxicity.train(docs, table, F.lit(True)))):
        rows = out.collect()
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in ROWS)
        assert all(0 <= r.score <= 1 for r in rows)
    empty = edge_docs(spark, [])
    assert quality_gam.score(empty, quality_gam.train(empty, table, F.lit(True))).collect() == []
    assert toxicity.score(empty, toxicity.train(empty, table, F.lit(True))).collect() == []


# ---- toxicity -------------------------------------------------------------
def weights(s, t):
    """Common subsequences by definition."""
    from itertools import combinations
    s, t, p = toxicity.START + s, toxicity.START + t, toxicity.ORDER
    return sum(toxicity.DECAY ** (a[-1] - a[0] + b[-1] - b[0] + 2)
               for a in combinations(range(len(s)), p) for b in combinations(range(len(t)), p)
               if all(s[i] == t[j] for i, j in zip(a, b)))


def test_kernel_matches_definition():
    marks, strings = ["idiot", "clown", "xy", "réeux"], ["idiot", "id-iot", "i.d.i.o.t", "clowns", "réeuxment", "ab", ""]
    k = toxicity.Landmarks(marks).kernel(strings)
    for i, s in enumerate(strings):
        for j, t in enumerate(marks):
            like = weights(s, t) / max(1e-20, (weights(s, s) * weights(t, t)) ** 0.5)
            want = np.exp(toxicity.SHARPNESS * (like - 1))
            assert k[i, j] == 0 or abs(k[i, j] - want) < 1e-4
    assert k[0, 0] > 0.999 and k[1, 0] > 0.1 and k[2, 0] > 0 and k[3, 1] > 0.1 and k[0, 1] == 0


def test_toxicity_held_out_accuracy_and_gaps(spark):
    assert accuracy(spark, op9_toxicity, "toxic") >= 0.9
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels, ~held_out(F.col("doc_id")))
    text = "Thonre was of the {} and thondor here."
    rows = [(k, text.format(w)) for k, w in enumerate(
        ["idiot", "IDIOT!", "id*iot", "i d i o t", "mor-on", "thndor", "intor", "ordinary"])]
    got = {r.doc_id: r.score >= 0.5 for r in toxicity.score(edge_docs(spark, rows), model).collect()}
    assert all(got[k] for k in range(5)) and not (got[5] or got[6] or got[7])

    # every learned insult in seven gapped forms; words that look a little like them stay clean
    insults = [w for w in model.landmarks.names[:toxicity.STRONGEST] if w in ("idiot", "moron", "clown", "loser", "scum", "trash", "stupid")]
    forms = [f(w) for w in insults for f in (
        lambda w: w[:2] + "*" + w[2:], lambda w: w[:3] + "-" + w[3:], lambda w: w[:2] + "x" + w[2:], ".".join, "*".join,
        lambda w: w[:1] + "*" + w[1:3] + "-" + w[3:], lambda w: w[:2] + "__" + w[2:])]
    clean = ["crown", "studio", "patriotic", "marathon", "discuss", "sum", "stupor", "well-known", "e-mail", "mother-in-law",
             "http://www.example.com/a-b", "don't", "co-operate", "idea", "trust"]
    rows = [(k, text.format(w)) for k, w in enumerate(forms + clean)]
    hit = {r.doc_id: r.score >= 0.5 for r in toxicity.score(edge_docs(spark, rows), model).collect()}
    assert len(insults) >= 3 and np.mean([hit[k] for k in range(len(forms))]) >= 0.9
    assert not any(hit[k] for k in range(len(forms), len(rows)))


# ---- licences -------------------------------------------------------------
NOTICES = {"gpl": "GNU General Public License", "proprietary": "All rights reserved.", "cc-by-nc": "CC BY-NC",
           "mit": "MIT License", "apache": "Apache License"}


def test_licences_of_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op1_licenses(spark, SF).collect():
        want = sorted(f for f, x in NOTICES.items() if x in docs[r.doc_id])
        assert r.families == want and (r.family in want or not want and r.family in ("none", "unknown"))


def test_licence_variants_and_edge_rows(spark):
    model = licenses.train(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = [(1, "LICENSED under the apache license, version 2"), (2, "See the license file."), (3, "driving license"),
            (4, "Intro text.\nReleased under the MIT License.\nAll rights reserved."), (5, "Licensed under the Foo License."),
            (6, None), (7, "")]
    got = {r.doc_id: (r.family, r.n_paragraphs) for r in licenses.families(edge_docs(spark, rows), model).collect()}
    assert got[1] == ("apache", 1) and got[4] == ("mit", 2) and got[6] == got[7] == ("none", 0)
    assert got[2][0] == got[3][0] == got[5][0] == "unknown"
    out = licenses.families(edge_docs(spark), model).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(i) for i, _ in ROWS)
    assert licenses.families(edge_docs(spark, []), model).collect() == []
    assert licenses.families(edge_docs(spark), licenses.train(edge_docs(spark, []))).count() == len(ROWS)
    plan = licenses.scan(edge_docs(spark), model)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


GPL = ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General "
       "Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your "
       "option) any later version.")
MIT = (" * Permission is hereby granted, free of charge, to any person\n * obtaining a copy of this software and "
       "associated documentation\n * files, to deal in the Software without restriction.")


def plain_scan(model, text):
    """Families by paragraph and line, with dictionaries: the definition read word by word."""
    weights = {r.run: list(r.w) for r in model.weights.collect()}
    names = {f: [t for t in all_] for f, all_ in licenses.TEMPLATES.items()}

    def split(t):
        t = re.sub(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", " ", t.lower())
        return re.sub("[0-9]+", "0", t).strip(" ").split(" ")

    def gather(w, lo, hi):
        return {" ".join(w[k:k + n]) for n in range(lo, hi + 1) for k in range(len(w) - n + 1)}

    def judge(unit):
        w = split(unit)
        if not set(w) & set(model.cues):
            return None
        known = [weights[r] for r in gather(w, 1, licenses.RUN) if r in weights]
        z = [(sum(x[k] for x in known) + b) / model.temperature for k, b in enumerate(model.intercepts)]
        p = [math.exp(x - max(z)) for x in z]
        best = max(range(len(z)), key=lambda k: p[k])
        family, pairs = model.classes[best], gather(w, 2, 2)
        alike = max((len(gather(split(t), 2, 2) & pairs) / len(gather(split(t), 2, 2)) for t in names.get(family, [])),
                    default=0)
        sure = family != "unknown" and p[best] / sum(p) >= model.least and alike >= licenses.CONFIRM
        return family if sure else "unknown"

    paragraphs, lines = [], text.split("\n")
    for k, line in enumerate(lines):
        going = k and 1 <= len(lines[k - 1]) <= licenses.WRAP and all(
            re.search("[A-Za-z0-9]", x) for x in (line, lines[k - 1]))
        if going:
            paragraphs[-1].append(line)
        else:
            paragraphs.append([line])
    out = []
    for k, p in enumerate(paragraphs):
        each = [(k, n, f) for n, x in enumerate(p) if (f := judge(x))]
        whole = judge("\n".join(p)) if len(p) > 1 else None
        if whole not in (None, "unknown") and all(f == "unknown" for _, _, f in each):
            each = [(k, licenses.WHOLE, whole)]
        out += each
    return out


def test_licence_scan_matches_plain_scorer_and_finds_wrapped_notices(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = licenses.train(docs)
    filler = "An ordinary line of text that says nothing about terms at all and goes on for quite a while, as lines do."
    rows = [(1, f"{filler}\n\n{GPL}\n\n{filler}"), (2, f"/*\n{MIT}\n */\nint x;"), (3, f"{GPL}\n\n{MIT}"),
            (4, GPL.replace("\n", " ")), (5, "the license\nof the driver"), (6, "x\x0bversion 2\r\nof the License"),
            (7, "word " * 50_000 + "license")]
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").where(
        "doc_id % 7 = 0 and text is not null").collect()]
    rows += [(1000 + i, t) for i, t in texts]
    got = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect():
        got.setdefault(r.doc_id, []).append((r.paragraph, r.line, r.family))
    want = {i: w for i, t in rows if (w := plain_scan(model, t))}
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert any(f != "unknown" for i, v in want.items() if i >= 1000 for _, _, f in v)
    named = {i: [f for _, _, f in v if f != "unknown"] for i, v in got.items()}
    assert named[1] == ["gpl"] and named[2] == ["mit"] and sorted(named[3]) == ["gpl", "mit"] and named[4] == ["gpl"]


def test_licence_copies_of_a_row_count_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = licenses.train(docs)
    lines = ["See the license file.", "Licensed under the Apache License.", "Released under the MIT License.", GPL]
    once = edge_docs(spark, list(enumerate(lines)))
    often = edge_docs(spark, [(i, x) for i, x in enumerate(lines) for _ in range(6)])
    a, b = (sorted((r.doc_id, r.paragraph, r.line, r.family, round(r.probability, 9))
                   for r in licenses.scan(d, model).collect()) for d in (once, often))
    assert a == b and a
    assert licenses.families(often, model).count() == 24


def test_licence_of_a_third_of_the_rows_is_found(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    notice = "\nLicensed under the Apache License, Version 2.0."
    hot = docs.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(notice))).otherwise(
        F.col("text")))
    got = licenses.families(hot, licenses.train(hot)).where(F.col("doc_id") % 3 == 0).select("families").collect()
    assert got and all("apache" in r.families for r in got)


def test_licence_cue_words_are_counted_over_all_texts(spark):
    """"granted" stands in the 300 texts with the smallest hashes alone, "warranty" in all others; the sample said
    the opposite. Variants of a notice and copies of a line or text don't make a word common."""
    name = F.translate(F.col("id").cast("string"), "0123456789", "bcdfghjklm")     # numbers are all the same word
    texts = spark.range(6000).select(F.concat(F.lit("an apple granted to neighbour "), name).alias("text"))
    texts = texts.orderBy(F.xxhash64("text")).limit(300)
    top = texts.agg(F.max(F.xxhash64("text"))).first()[0]
    more = spark.range(6000).select(F.concat(F.lit("an apple without warranty for neighbour "), name).alias("text"))
    more = more.where(F.xxhash64("text") > top).limit(3600)
    more = more.withColumn("text", F.concat("text", F.lit("\nredistribute it as you like")))
    docs = texts.unionByName(more).unionByName(texts.limit(1)).unionByName(
        spark.createDataFrame([(None,), ("",), ("permission\n" * 900,)], "text string"))
    docs = docs.unionByName(spark.range(500).select(F.concat(F.lit("Released under the MIT License "), name).alias("text")))
    cues = licenses.train(docs.withColumn("doc_id", F.monotonically_increasing_id())).cues
    assert {"granted", "redistribute", "permission", "released", "mit"} <= set(cues)
    assert not {"warranty", "without", "an"} & set(cues)
