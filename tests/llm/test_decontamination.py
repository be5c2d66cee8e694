import random
import re

import numpy as np
from pyspark.sql import functions as F

from spokewise.llm import decontamination as dc
from spokewise.llm.queries import op4_decontamination
from tests.llm.edge import LINE, edge_docs

SF = "/root/testdata/sf0.001"


def split(text):
    han = r"[\u0e00-\u0eff\u3040-\u30ff\u4e00-\u9fff\U00020000-\U00033fff]"
    spaced = re.sub(f"({han})", r" \1 ", (text or "").lower())
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", spaced)


def nearest(pattern, text):
    """Smallest edit distance of the pattern to a part of the text."""
    row, at = np.zeros(len(text) + 1, int), np.arange(len(text) + 1)
    for i, x in enumerate(pattern, 1):
        now = np.empty(len(text) + 1, int)
        now[0] = i
        now[1:] = np.minimum(row[:-1] + np.array([x != y for y in text], int), row[1:] + 1)
        row = np.minimum.accumulate(now - at) + at
    return int(row.min())


def expected(docs, items):
    out = {}
    for d, t in docs:
        w = split(t)
        for i, p in items:
            p = split(p)
            if p:
                n = nearest(p, w)
                if n <= int(dc.MAX_ERROR * len(p) + 1e-9):
                    out.setdefault((d, i), []).append(n)
    return {k: sorted(v) for k, v in out.items()}


def found(rows):
    out = {}
    for r in rows:
        out.setdefault((r.doc_id, r.item_id), []).append(r.distance)
    return {k: sorted(v) for k, v in out.items()}


def test_myers_and_best_part():
    random.seed(2)
    for _ in range(400):
        p = [random.randrange(4) for _ in range(random.randint(1, 12))]
        t = [random.randrange(4) for _ in range(random.randint(0, 25))]
        d, a, b = dc.best_part(p, t)
        assert d == dc.myers(p, t)[0] == nearest(p, t)
        if b > a:
            full = list(range(len(p) + 1))
            for j, x in enumerate(t[a:b], 1):
                last, full[0] = full[0], j
                for k, y in enumerate(p, 1):
                    last, full[k] = full[k], min(last + (x != y), full[k] + 1, full[k - 1] + 1)
            assert full[-1] == d


def test_edited_items_and_slices(spark):
    random.seed(6)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = []
    for n in range(60):
        _, p = random.choice(items)
        q = split(p)
        for _ in range(random.randint(0, int(0.3 * len(q)))):
            k, what = random.randrange(len(q)), random.random()
            if what < 0.4:
                q[k] = f"zz{k}"
            elif what < 0.7:
                q.insert(k, "YY!")
            elif len(q) > 5:
                del q[k]
        docs.append((n, f"{LINE} {' '.join(q)} {LINE}"))
    table = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = expected(docs, items)
    assert want
    for size in (1 << 20, 2500):
        assert found(dc.find_items(edge_docs(spark, docs), table, slice_bytes=size).collect()) == want


def test_edge_rows(spark):
    docs = edge_docs(spark)
    items = spark.createDataFrame([(1, LINE.upper()), (2, None), (3, ""), (None, LINE), (5, "one"), (1, LINE.upper())],
                                  "item_id long, text string")
    got = found(dc.find_items(docs, items).collect())
    assert got[1, 1] == [0, 0] and got[3, 1] == [1, 1] and got[None, 1] == [0, 0] and got[1, None] == [0]
    assert got[9, 5] == [0, 0]  # one word, found word for word
    assert not any(i in (2, 3) for _, i in got) and not any(d in (4, 5, 6) for d, _ in got)
    assert dc.find_items(edge_docs(spark, []), items).collect() == []
    assert dc.find_items(docs, items.limit(0)).collect() == []
    left = dc.remove_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(
        map(str, (4, 5, 6, 7, 8, 10, None, 11, 13, -5)))


def test_short_items_scripts_without_blanks_and_ids_of_any_type(spark):
    docs = [("1.5", "he said the cat sat there"), ("2.5", "the cat, sat"), ("3.5", "the cat has sat"),
            ("4.5", "他说今天天气很好我们一起去公园散步吧然后回家"), ("5.5", "今天天气不错我们去学校"), (None, "𠀀𠀁ก𠀂 end")]
    items = [("i", "the cat sat"), (None, "今天天气很好我们一起去公园玩吧"), ("k", "𠀀𠀁ก"), ("i", "THE cat sat")]
    left = spark.createDataFrame(docs, "doc_id string, text string").withColumn(
        "doc_id", F.col("doc_id").cast("decimal(20,1)"))
    right = spark.createDataFrame(items, "item_id string, text string").withColumn("item_id", F.struct("item_id"))
    got = [(str(r.doc_id) if r.doc_id is not None else None, r.item_id.item_id, r.distance)
           for r in dc.find_items(left, right).collect()]
    want = [(d, i, n) for (d, i), all_ in expected(docs, items).items() for n in all_]
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(want) == 6
    assert {str(r.doc_id) for r in dc.remove_contaminated(left, right).collect()} == {"3.5", "5.5"}
    assert dc.find_items(left, right, min_words=4).count() == 1


def test_slices_are_bounded_also_with_copies_of_an_item(spark):
    rows = spark.range(600).select(F.lit("one and the same item of a benchmark that was given very often").alias("text"))
    long = spark.range(40).select(F.concat(F.lit("item "), F.repeat(F.col("id").cast("string"), 300)).alias("text"))
    texts = dc._texts(rows.unionByName(long))
    sizes = [texts.where(c).agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0 for c in dc._slices(texts, 2048)]
    assert sum(sizes) == texts.agg(F.sum(F.octet_length("text") + 64)).first()[0]
    assert len(sizes) > 3 and max(sizes) <= 2048


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(120).collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    ids = {d for d, _ in docs}
    got = [r for r in op4_decontamination(spark, SF).collect() if r.doc_id in ids]
    assert found(got) == expected(docs, items)
