"""Whitening and hard negatives against plain versions over hand-written and generated rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from spokewise.llm import hard_negatives, queries, whitening
from tests.conftest import SF_SMALL

CLASH = "x string, weight string, id string, n string, white string, block string, chunk string"
NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    """(vec_id, label, embedding) with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, label, v, *"abcdefg") for i, label, v in rows],
                                 f"vec_id long, label int, embedding array<float>, {CLASH}")


def generated(n, dims, seed, copies=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (4, dims))
    rows = []
    for i in range(n):
        v = (centres[i % 4] + rng.normal(0, 0.4, dims)).astype(np.float32)
        if i < copies:
            v = centres[0].astype(np.float32)           # one vector that holds many rows
        rows.append((i, int(rng.integers(0, 3)), [float(c) for c in v]))
    return rows


ODD = [(900, 1, None), (901, 1, []), (902, 1, [NAN] * 6), (903, 1, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
       (904, 1, [INF, 0.0, 0.0, 0.0, 0.0, 0.0]), (905, 1, [1.0, 2.0])]


# ------------------------------------------------------------------ whitening

def plain_whitening(rows, k):
    kept = [(i, v) for i, _, v in rows if v and len(v) == 6 and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in x]
    z = np.array([[(n * c - s) / n for c, s in zip(r, sums, strict=True)] for r in x])
    e, u = np.linalg.eigh(z.T @ z / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return [i for i, _ in kept], n, deviation, z @ u / np.sqrt(e), e / np.trace(z.T @ z / n)


def test_whitening_against_numpy(spark):
    rows = generated(400, 6, 1, copies=150) + ODD + [(None, 2, [0.5] * 6), (7, 0, [0.25] * 6), (7, 0, [0.25] * 6)]
    got = whitening.whiten(frame(spark, rows), components=4).toPandas()
    ids, n, deviation, white, explained = plain_whitening(rows, 4)
    assert len(got) == 4 * n and set(got.n) == {n} and got.identity_error.max() < 1e-9
    key = lambda r: (-1 if r[0] is None or r[0] != r[0] else r[0], r[1])
    mine = sorted(((i, int(d)) for i, d, k in zip(got.vec_id, got.deviation, got.component, strict=True) if k == 1), key=key)
    assert [d for _, d in mine] == [d for _, d in sorted(zip(ids, deviation, strict=True), key=key)]
    for k in range(1, 5):
        part = got[got.component == k]
        order = np.lexsort((part.deviation.astype(float), part.vec_id.fillna(-1)))
        theirs = np.lexsort((np.array(deviation, float), np.array([-1 if i is None else i for i in ids])))
        a, b = part.whitened.to_numpy()[order], white[theirs, k - 1]
        assert np.allclose(a * np.sign(a @ b), b, atol=1e-9)
        assert np.allclose(part.explained, explained[k - 1], rtol=1e-9)


def test_whitening_without_variance_and_without_rows(spark):
    same = whitening.whiten(frame(spark, [(i, 0, [1.0, 2.0]) for i in range(5)])).toPandas()
    assert len(same) == 10 and same.whitened.isna().all() and set(same.explained) == {0.0}
    assert set(same.identity_error) == {0.0} and set(map(int, same.deviation)) == {0}
    line = whitening.whiten(frame(spark, [(i, 0, [float(i), 1.0]) for i in range(5)])).toPandas()
    assert line[line.component == 2].whitened.isna().all() and not line[line.component == 1].whitened.isna().any()
    assert whitening.whiten(frame(spark, ODD[:5])).count() == 0
    assert whitening.whiten(frame(spark, [])).columns == whitening.whiten(frame(spark, [(1, 1, [1.0])])).columns


def test_whitening_stays_exact_beyond_64_bits(spark):
    rows = [(i, 0, [float(2 ** 40 * (i % 3)), float(i)]) for i in range(30)]
    got = whitening.whiten(frame(spark, rows)).where("component = 1").select("vec_id", "deviation").collect()
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, _, v in rows]
    sums = [sum(c) for c in zip(*x, strict=True)]
    want = {i: sum((30 * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for i, r in enumerate(x)}
    assert {r.vec_id: int(r.deviation) for r in got} == want


# ------------------------------------------------------------------ hard negatives

def plain_negatives(rows, every, k_pos=5, k_neg=10):
    best = {}
    for i, label, v in rows:
        if i is None or label is None or not v or len(v) != 6 or any(c is None or not math.isfinite(c) for c in v):
            continue
        x = [math.floor(256 * float(np.float32(c))) for c in v]
        best[i] = min(best.get(i, (label, x)), (label, x))
    out = []
    for a, (label, x) in best.items():
        if a % every:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(x, y, strict=True)), i, other) for i, (other, y) in best.items() if i != a))
        for p, pid, _ in [r for r in scored if r[2] == label][:k_pos]:
            inside = [r for r in scored if r[2] != label and 30 * -p <= 100 * -r[0] <= 90 * -p][:k_neg]
            out += [(a, pid, rank, r[1], -p, -r[0]) for rank, r in enumerate(inside, 1)]
    return sorted(out)


def mined(spark, rows, every):
    got = hard_negatives.mine(frame(spark, rows), F.col("id") % every == 0)
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("sizes", [(2048, 16_384, 1024, 2048), (7, 60, 20, 16)])
def test_hard_negatives_against_brute_force(spark, monkeypatch, sizes):
    """Also with many small blocks, chunks and slices."""
    for name, v in zip(("BLOCK", "CHUNK", "LEAST_CHUNK", "SLICE"), sizes, strict=True):
        monkeypatch.setattr(hard_negatives, name, v)
    rows = generated(300, 6, 2, copies=80) + ODD + [
        (None, 1, [1.0] * 6), (10, None, [1.0] * 6), (20, 0, [3.0] * 6), (20, 0, [3.0] * 6), (-30, 2, [0.5] * 6), (30, 1, [-1.0] * 6)]
    want = plain_negatives(rows, 10)
    assert want and mined(spark, rows, 10) == want


def test_hard_negatives_without_anchors_or_rows(spark):
    assert mined(spark, [], 10) == [] and mined(spark, ODD[:5], 1) == []
    assert mined(spark, generated(9, 6, 3)[1:], 10) == []
    assert mined(spark, generated(1, 6, 3), 10) == []


def test_tree_bounds_spare_scores():
    """In clustered rows most pairs are never scored, and those that are wanted all are."""
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 60, (10, 16))
    x = np.floor(centres[np.arange(600) % 10] + rng.normal(0, 1, (600, 16))).astype(np.int64)
    order, parent, edge = hard_negatives.spanning_tree(x[:200])
    block = hard_negatives.Anchors.__new__(hard_negatives.Anchors)
    block.ids, block.labels, block.x = np.arange(200), np.zeros(200), x[:200][order]
    block.parent, block.edge, block.levels = parent, edge, hard_negatives._levels(parent)
    exact = block.x @ x.T
    cut = np.quantile(exact, 0.95)
    score, done = block.scores(x, lambda nodes, low, high: high >= cut)
    assert (score[done] == exact[done]).all() and done[exact >= cut].all()
    assert done.mean() < 0.4


def test_windows_are_exact():
    p = np.array([0, 1, 7, 100, 333, -5])
    first, last = hard_negatives.windows_of(p, 30, 90)
    for v, a, b in zip(p.tolist(), first.tolist(), last.tolist(), strict=True):
        inside = [s for s in range(-400, 401) if 30 * v <= 100 * s <= 90 * v]
        assert inside == list(range(a, b + 1))


def test_queries_have_the_contract_columns(spark):
    w = queries.op11_whitening(spark, SF_SMALL)
    assert dict(w.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
                              "whitened": "double", "explained": "double", "identity_error": "double"}
    assert w.count() == 8 * 500 and w.where("deviation is null or identity_error > 1e-4").count() == 0
    h = queries.op12_hard_negatives(spark, SF_SMALL)
    assert dict(h.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint",
                              "positive_score": "bigint", "negative_score": "bigint"}
