import corpus_pipeline as cp
from spokewise.llm import decontamination, quality_rules
from spokewise.llm.common import written
from tests.llm.edge import ROWS, edge_docs
from tests.llm.test_line_dedup import expected as line_expected
from tests.llm.test_simhash import close, fingerprint, groups

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    """Each stage on what its predecessor kept, held against that stage's plain version."""
    docs, steps = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in cp.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()} if name != "quality_rules" else None
        docs = written(stage(spark, docs, SF), f"test-{name}")
        steps.append(name)
        after = docs.collect()
        if name != "bpe":
            assert docs.columns == list(cp.COLUMNS)
            assert all(r.n_chars == len(r.text) for r in after)
        kept = {r.doc_id: r for r in after}
        if name == "quality_rules":
            q = quality_rules.judge(spark.read.parquet(f"{SF}/documents.parquet"))
            assert {k: r.text for k, r in kept.items()} == {
                r.doc_id: r.quality.clean_text for r in q.where("quality.kept").collect()}
        elif name == "line_dedup":
            want = {}
            for x in line_expected(list(before.items())):
                i, _, _, cut = eval(x)  # noqa: S307 - our own tuple text
                text = "\n".join(t for k, t in enumerate(before[i].split("\n")) if k not in cut)
                if text.strip(" \t\n\x0b\x0c\r") or not cut:
                    want[i] = text
            assert {k: r.text for k, r in kept.items()} == want
        elif name == "near_duplicates":
            ids = sorted(before)
            top = groups([fingerprint(before[i]) for i in ids], close)
            assert set(kept) == {ids[min(k for k, g in enumerate(top) if g == t)] for t in set(top)}
        elif name == "decontamination":
            table = spark.read.parquet(f"{SF}/benchmark.parquet")
            hit = {r.doc_id for r in decontamination.find_items(edge_docs(spark, list(before.items())), table).collect()}
            assert set(kept) == set(before) - hit
        else:
            assert set(kept) == set(before)
    assert steps == ["quality_rules", "line_dedup", "near_duplicates", "decontamination", "bpe"]
    assert sorted(r.doc_id for r in cp.run(spark, SF).collect()) == sorted(kept)


def test_stages_on_edge_rows_and_empty_table(spark):
    for rows in (ROWS, []):
        docs = edge_docs(spark, rows)
        for _, stage in cp.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= len(rows)
