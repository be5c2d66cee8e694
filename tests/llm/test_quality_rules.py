from collections import Counter

from spokewise.llm import quality_rules
from spokewise.llm.queries import op10_quality_rules
from tests.llm.edge import LINE, OTHER, ROWS, edge_docs, words

SF = "/root/testdata/sf0.001"


def base(text):
    w = words(text)
    runs = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if runs[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w))


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_of_edge_rows(spark):
    out = quality_rules.judge(edge_docs(spark), out="quality").select("doc_id", *(f"quality.{c}" for c in COLUMNS))
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(str((i, *base(t))) for i, t in ROWS)


def test_query_matches_brute_force(spark):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:7] for r in op10_quality_rules(spark, SF).collect()}
    assert got == {i: base(t) for i, t in text.items()}


def test_verdicts(spark):
    prose = LINE + ".\n" + OTHER + "\n"
    rows = [(1, prose * 1), (2, "\n".join(w + "*** x$$$" for w in LINE.split())), (3, "a | b | c | d\n" * 1 + prose),
            (4, " ".join(f"{w}!!" for w in (LINE + " " + OTHER).split())),
            (5, "Home | News | Sport | Help | Shop | Login | " * 6 + "\nshort text"),
            (6, "All rights reserved.\n" + prose)]
    out = {r.doc_id: r.quality for r in quality_rules.judge(edge_docs(spark, rows)).collect()}
    assert {k: v.kept for k, v in out.items()} == {1: True, 2: False, 3: True, 4: False, 5: False, 6: True}
    assert out[3].clean_text == prose and out[6].clean_text == prose  # only the failing line goes
    assert out[3].lost_chars == 7


def test_labels_agree(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in op10_quality_rules(spark, sf).collect() if r.doc_id in labels]
    assert all(r.kept for r in rows if labels[r.doc_id] == 1 and not r.base_failed)
    assert not any(r.kept for r in rows if labels[r.doc_id] == 0)


def test_no_python_in_plan(spark):
    plan = op10_quality_rules(spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))


def test_clean_keeps_columns_and_empty_table(spark):
    docs = edge_docs(spark)
    assert quality_rules.clean(docs).columns == docs.columns
    assert quality_rules.clean(edge_docs(spark, [])).collect() == []
