"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a few numbers (word shape, symbols, repetition, lines),
each number a bin. Training boosts shallow trees cyclically, one feature
after the other at a small rate, so every feature ends up with a lookup
table over its bins; afterwards the feature pairs that explain most of the
remaining gradient get two-dimensional tables in the same way. A score is
the logistic function of the sum of the looked-up values: vectorised
additions, in the tasks that read the texts, without a shuffle.

The model is fitted on at most ``MAX_ROWS`` labelled rows (those with the
smallest id hashes), fetched as feature rows of fixed width; the labels
that select them are broadcast, which that number bounds. Everything else
covers all rows.

Defined results: a null text counts as empty and gets a score like any
other; labels with a null id or value are not used, of several labels of
one id the largest counts; without labels of both kinds every score is the
smoothed share of label 1 (0.5 without any). Repeated rows give repeated
results, extra columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spokewise.llm import wordstream as ws
from spokewise.llm.common import one_text_an_id

MAX_ROWS = 20_000    # labelled rows that the model is fitted on
BINS = 48            # of a feature
PAIR_BINS = 8        # of each feature in an interaction
ROUNDS, PAIR_ROUNDS, PAIRS = 200, 60, 8
RATE = 0.1
LEAVES = 4           # of a shallow tree
RIDGE = 2.0

FEATURES = ("words", "word_bytes", "symbols", "bars", "shouts", "capitals", "digits", "stops", "non_ascii",
            "lines", "stutter", "same_words", "same_runs", "short_words", "longest_word", "closed_lines")


def _marks(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_SYMBOL, _BAR, _SHOUT, _STOP, _LINE = _marks("#*$%&<>"), _marks("|"), _marks("!?"), _marks(".,;:"), _marks("\n")
_CAPITAL, _DIGIT = _marks("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _marks("0123456789")
_LETTER = _CAPITAL | _marks("abcdefghijklmnopqrstuvwxyz")
_CLOSE = _marks(".!?:;\"')")
_HIGH = np.arange(256) > 127


def _per_text(marked: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(marked, dtype=np.int64)])
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)


def _repeated(text: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """For each text, how many of its hashes are not the first of their value."""
    if not len(h):
        return np.zeros(n)
    _, first = np.unique(ws.mix(h + ws.mix(text.astype(np.uint64))), return_index=True)
    return (np.bincount(text, minlength=n) - np.bincount(text[first], minlength=n)).astype(float)


def features(w: ws.Words) -> np.ndarray:
    """One row of ``FEATURES`` per text of a block."""
    n_texts, b, d = len(w.first) - 1, w.text_bounds, w.data
    n = np.diff(w.first).astype(float)
    some, size = np.maximum(n, 1), np.maximum(np.diff(b), 1)
    width = w.stop - w.start
    text = np.repeat(np.arange(n_texts), np.diff(w.first))
    letters = np.maximum(_per_text(_LETTER[d], b), 1)
    lines = _per_text(_LINE[d], b) + 1
    # last byte before each line end
    ends = np.flatnonzero(_LINE[d])
    last = np.concatenate([ends, b[1:][np.diff(b) > 0]]) - 1
    owner = np.searchsorted(b, last, "right") - 1
    good = (last >= 0) & (owner >= 0)
    closed = np.bincount(owner[good][_CLOSE[d[last[good]]]], minlength=n_texts)[:n_texts]
    same_as_last = np.zeros(len(w.hashes), bool)
    same_as_last[1:] = (w.hashes[1:] == w.hashes[:-1]) & (text[1:] == text[:-1])
    at, run = w.windows(5)
    longest = np.zeros(n_texts)
    np.maximum.at(longest, text, width)
    total = lambda x: np.bincount(text, x, minlength=n_texts)[:n_texts]
    return np.stack([
        np.log1p(n), total(width) / some, _per_text(_SYMBOL[d], b) / some, _per_text(_BAR[d], b) / some,
        _per_text(_SHOUT[d], b) / some, _per_text(_CAPITAL[d], b) / letters, _per_text(_DIGIT[d], b) / size,
        _per_text(_STOP[d], b) / some, _per_text(_HIGH[d], b) / size, lines / some, total(same_as_last) / some,
        _repeated(text, w.hashes, n_texts) / some, _repeated(text[at], run, n_texts) / some, total(width <= 2) / some,
        np.log1p(longest), closed / lines], axis=1).astype(np.float32)


@dataclass
class Model:
    """Bin edges and lookup tables; ``pairs`` are (feature, feature, table) over coarse bins."""

    start: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.start)
        for k, (edge, values) in enumerate(zip(self.edges, self.tables)):
            z += values[np.searchsorted(edge, x[:, k], "right")]
        for i, j, values in self.pairs:
            z += values[np.searchsorted(self.coarse[i], x[:, i], "right"),
                        np.searchsorted(self.coarse[j], x[:, j], "right")]
        return z

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Values over bins of a tree with so many leaves, grown greedily on gradient and curvature sums."""
    cuts = [0, len(g)]
    G, H = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    gain = lambda a, b: (G[b] - G[a]) ** 2 / (H[b] - H[a] + RIDGE)
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:]):
            m = np.arange(a + 1, b)
            if len(m):
                won = gain(a, m) + gain(m, b) - gain(a, b)
                k = int(won.argmax())
                best = max(best, (float(won[k]), int(m[k])), key=lambda x: x[0])
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = (G[b] - G[a]) / (H[b] - H[a] + RIDGE)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, values) of the best tree with one cut on each axis (four leaves) over a grid."""
    G, H = (np.pad(x, ((1, 0), (1, 0))).cumsum(0).cumsum(1) for x in (g, h))
    best, values = 0.0, np.zeros_like(g)
    n, m = g.shape
    for a in range(1, n):
        for b in range(1, m):
            won, cells = 0.0, []
            for r0, r1 in ((0, a), (a, n)):
                for c0, c1 in ((0, b), (b, m)):
                    s = G[r1, c1] - G[r0, c1] - G[r1, c0] + G[r0, c0]
                    t = H[r1, c1] - H[r0, c1] - H[r1, c0] + H[r0, c0]
                    won += s * s / (t + RIDGE)
                    cells.append((r0, r1, c0, c1, s / (t + RIDGE)))
            if won > best:
                best, values = won, np.zeros_like(g)
                for r0, r1, c0, c1, v in cells:
                    values[r0:r1, c0:c1] = v
    return best, values


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of the logistic loss: single features first, then the strongest pairs."""
    n, k = len(y), len(FEATURES)
    share = (y.sum() + 0.5) / (n + 1)
    start = float(np.log(share / (1 - share)))
    edges, coarse = [], []
    for c in range(k):
        for count, into in ((BINS, edges), (PAIR_BINS, coarse)):
            q = np.quantile(x[:, c], np.linspace(0, 1, count + 1)[1:-1]) if n else np.zeros(0)
            into.append(np.unique(q))
    model = Model(start, edges, [np.zeros(len(e) + 1) for e in edges], coarse, [])
    if n == 0 or y.min() == y.max():
        return model
    bins = [np.searchsorted(e, x[:, c], "right") for c, e in enumerate(edges)]
    z = np.full(n, start)
    for _ in range(ROUNDS):
        for c in range(k):
            p = 1 / (1 + np.exp(-z))
            size = len(model.tables[c])
            step = RATE * _tree(np.bincount(bins[c], y - p, size), np.bincount(bins[c], p * (1 - p), size), LEAVES)
            model.tables[c] += step
            z += step[bins[c]]
    low = [np.searchsorted(e, x[:, c], "right") for c, e in enumerate(coarse)]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        cell = low[i] * shape[1] + low[j]
        return (np.bincount(cell, y - p, shape[0] * shape[1]).reshape(shape),
                np.bincount(cell, p * (1 - p), shape[0] * shape[1]).reshape(shape))

    strength = sorted(((_pair_tree(*grid(i, j))[0], i, j) for i in range(k) for j in range(i)), reverse=True)
    tables = {(i, j): np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)) for _, i, j in strength[:PAIRS]}
    for _ in range(PAIR_ROUNDS):
        for (i, j), values in tables.items():
            step = RATE * _pair_tree(*grid(i, j))[1]
            values += step
            z += step[low[i], low[j]]
    model.pairs = [(i, j, v) for (i, j), v in tables.items()]
    return model


def _features_of(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``x``: the features of the text in column ``text``."""
    schema = docs.select(*keep, F.array(F.lit(0.0).cast("float")).alias("x")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index("text")
            x = np.concatenate([features(w) for _, _, w in ws.blocks(b.column(at))] or [np.zeros((0, len(FEATURES)))])
            rows = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES),
                                            pa.array(x.ravel(), pa.float32()))
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in keep), rows],
                                             names=[*keep, "x"])

    return docs.select(*keep, "text").mapInArrow(run, schema)


def sampled_labels(labels: DataFrame, label: str, usable: Column, max_rows: int) -> DataFrame:
    """(doc_id, y): at most ``max_rows`` labels of usable rows, those with the smallest id hashes."""
    known = labels.where(usable & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    return (known.groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("y"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality",
          max_rows: int = MAX_ROWS) -> Model:
    """Fit on the labelled documents for which ``usable`` (a condition on ``labels``) holds."""
    chosen = sampled_labels(labels, label, usable, max_rows)
    # at most max_rows pairs of numbers: a bound that does not grow with the data
    labelled = one_text_an_id(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "y")
    rows = _features_of(labelled, ["y"]).collect()
    x = np.array([r.x for r in rows], np.float32).reshape(-1, len(FEATURES))
    return fit(x, np.array([r.y for r in rows], float))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score): the probability of label 1 for every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers
    src = docs.select("doc_id", "text")
    schema = src.select("doc_id", F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [shared.value.scores(features(w)) for _, _, w in ws.blocks(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.concatenate(s) if s else np.zeros(0), pa.float64())],
                names=["doc_id", "score"])

    return src.mapInArrow(run, schema)
