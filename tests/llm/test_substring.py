import hashlib
import random

import pytest

from spokewise.llm import substring_dedup as sd
from spokewise.llm.queries import op5_substring_dedup
from tests.llm.edge import ROWS, edge_docs, words

SF = "/root/testdata/sf0.001"


def expected(rows, window=20):
    """Words left per row, by definition; rows with equal (id, start) do not remove each other."""
    low = float("-inf")
    first = {}
    for i, t in rows:
        w = words(t)
        for s in range(len(w) - window + 1):
            k, at = tuple(w[s:s + window]), (low if i is None else i, s)
            first[k] = min(first.get(k, at), at)
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < (low if i is None else i, s):
                gone[s:s + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(map(str, out))


def run(docs, window=20):
    out = sd.remove_repeats(docs, window=window).select("doc_id", "n_words", "n_removed", sd.kept_digest())
    return sorted(str(tuple(r)) for r in out.collect())


def test_edge_rows(spark):
    assert run(edge_docs(spark)) == expected(ROWS)


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(str(tuple(r)) for r in op5_substring_dedup(spark, SF).collect()) == expected(rows)


@pytest.mark.parametrize("batch", ["1", "3", "10000"])
def test_random_texts_in_small_batches(spark, batch):
    random.seed(int(batch))
    rows = []
    for i in range(60):
        passages = ["".join(random.choice("ab") + " " for _ in range(random.randint(0, 40))) for _ in range(2)]
        rows.append((random.randint(0, 40), " ".join(passages)))
        if i % 4 == 0:
            rows.append((random.randint(0, 40), rows[-1][1] + random.choice(["", " c", "\n" + passages[0]])))
    # same id, different text: places compare, so keep ids unique per text here
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    random.shuffle(rows)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert run(edge_docs(spark, rows), 6) == expected(rows, 6)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_empty_table(spark):
    assert run(edge_docs(spark, [])) == []
