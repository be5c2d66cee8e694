"""Toxicity: support vector machine on a subsequence string kernel with Nystroem landmarks.

Two strings are alike by the weighted common subsequences of ``ORDER``
letters; every skipped letter costs a factor ``DECAY``, so an insult with
inserted or missing characters stays near the plain one. A sentence counts
by its strongest word (runs of single spaced letters are read as one word),
a text by its strongest sentence.

Training takes a bounded sample of labelled texts (``MAX_TOXIC`` and
``MAX_CLEAN``, those with the smallest id hashes; near copies of one text
count once). All sentences of clean texts are clean; of a toxic text the
sentence with the strongest evidence is toxic, and its witness is the word
whose letters (or a beginning of them) stand in toxic texts far more often
than in clean ones (likelihood ratio). The strongest of these strings are
the landmarks. Words are embedded by the kernel to the landmarks
(Nystroem), a linear machine with squared hinge loss separates witnesses,
also with a letter inserted, from the words of clean sentences, first
sampled ones, then also those that the first machine takes for the
worst. Scores are calibrated by a logistic fit on the sampled texts; its
even odds are moved down to where most of the strongest witnesses are found with a letter
inserted, but not below clean texts. A word with punctuation inside counts as it is
or by its letters alone, whichever is stronger, so an insult is found with any
characters between its letters, or with one foreign letter inside; two foreign
letters inside a short word are not told from clean words.

Scoring needs no shuffle: tasks take the distinct words of a block, compute
kernels for those not in the worker's bounded memo, and take the maximum
per text.

Defined results: a null or blank text has no words and gets the score of
the weakest word; words of fewer letters than ``ORDER`` are alike to
nothing; longer words than ``WIDTH`` count by their strongest overlapping
piece; labels with a null id or value are not used; without evidence every
score is the smoothed share of toxic texts in the sample. Repeated rows
give repeated results, extra columns are ignored, an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spokewise.llm import wordstream as ws
from spokewise.llm.common import one_text_an_id, written

MAX_TOXIC, MAX_CLEAN = 1500, 4500   # labelled texts that the model is fitted on
ORDER, DECAY = 3, 0.7               # of the kernel
WIDTH = 32                          # letters of a piece of a word
START = "^^"                        # stands before each word, so that beginnings weigh more
LANDMARKS, CLEAN_LANDMARKS = 128, 32
SHARPNESS = 5.0                     # of the kernel's exponential
SHARED = 0.4                        # share of a landmark's letter pairs that a word must have
_PAIRS = 4093
EVIDENCE = 9.0                      # log likelihood ratio from which on a string is evidence
PREFIX = (4, 12)                    # letters of the beginnings that are counted
MAX_WITNESSES, SAMPLED_WORDS, HARD_WORDS = 600, 12_000, 2_000
COST = 5.0
STRONGEST = 10                      # landmarks whose forms with a letter inserted place the even odds
MEMO = 1_000_000                    # words of a worker's memo
_EDGE = "".join(chr(c) for c in range(33, 128) if not chr(c).isalnum())


# ---- kernel ----------------------------------------------------------------
def _letters(words: list[str], pad: int) -> np.ndarray:
    """Code points of START and each word, one row a word, filled up with ``pad``."""
    wide = WIDTH + len(START)
    out = np.array([START + w for w in words], dtype=f"<U{wide}").view(np.uint32).reshape(len(words), wide)
    return np.where(out == 0, np.uint32(pad), out)


def subsequences(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Weight of the common subsequences of each column of ``a`` with the same column of ``b`` (letter, pair).

    running[q][j]: weight of the common subsequences of q + 1 letters that end before letter i of
    ``a`` and at letter j of ``b``, decayed by their distance to i.
    """
    running = [np.zeros(b.shape, np.float32) for _ in range(ORDER - 1)]
    decay, out = np.float32(DECAY), np.zeros(b.shape[1], np.float32)
    for letter in a:
        same = (b == letter).astype(np.float32)
        same *= decay * decay
        ends = same
        for q in range(ORDER - 1):
            # over j: subsequences that end before j, decayed by the distance
            longer, before = np.empty_like(same), np.zeros_like(out)
            for j in range(len(same)):
                np.multiply(same[j], before, out=longer[j])
                before *= decay
                before += running[q][j]
            running[q] *= decay
            running[q] += ends
            ends = longer
        out += ends.sum(axis=0)
    return out


def _in_parts(a: np.ndarray, b: np.ndarray, size: int = 4096) -> np.ndarray:
    return np.concatenate([subsequences(a[:, k:k + size], b[:, k:k + size]) for k in range(0, a.shape[1], size)]
                          or [np.zeros(0, np.float32)])


def _own(x: np.ndarray) -> np.ndarray:
    """Kernel of each column with itself; its padding (0 or 1) is not equal to itself."""
    return _in_parts(x, np.where(x < 2, np.uint32(2), x))


def _pairs(x: np.ndarray) -> list[np.ndarray]:
    """Numbers of the neighbouring letters of each row, and of those with one letter between them."""
    x = x[:, len(START):].astype(np.int64)
    out = []
    for gap in (1, 2):
        first, second = x[:, :-gap], x[:, gap:]
        out.append(np.where((first > 2) & (second > 2), (first * 31 + second) % _PAIRS, _PAIRS))
    return out


class Landmarks:
    """Strings that words are compared with."""

    def __init__(self, names: list[str]):
        self.names = names
        self.letters = _letters(names, 1)[:, :len(START) + max(map(len, names))]   # no letters beyond the longest
        self.own = _own(self.letters.T)
        table = np.zeros((_PAIRS + 1, len(names)), np.uint8)
        near, _ = _pairs(self.letters)
        for k, row in enumerate(near):
            table[row, k] = 1
        table[_PAIRS] = 0
        self.table = table
        self.need = np.maximum(1, np.ceil(SHARED * table.sum(axis=0))).astype(np.uint8)

    def kernel(self, words: list[str]) -> np.ndarray:
        """Kernel of every word (up to ``WIDTH`` letters) to every landmark.

        exp(SHARPNESS * (K - 1)) of the normalised subsequence kernel K; zero for words that share too
        few of a landmark's neighbouring letters (also with a letter between them).
        """
        out = np.zeros((len(words), len(self.names)), np.float32)
        order = np.argsort([len(w) for w in words], kind="stable")
        for k in range(0, len(words), 2048):  # words of about the same length together
            part = order[k:k + 2048]
            n = min(WIDTH, max(len(words[p]) for p in part)) + len(START)
            a = _letters([words[p] for p in part], 0)[:, :n]
            shared = np.zeros((len(part), len(self.names)), np.uint8)
            for numbers in _pairs(a):
                for column in numbers.T:
                    shared += self.table[column]
            word, mark = np.nonzero(shared >= self.need)
            if not len(word):
                continue
            some, at = np.unique(word, return_inverse=True)
            mine = a[some].T
            own = _own(mine)
            both = _in_parts(a[word].T, self.letters[mark].T)
            like = both / np.sqrt(np.maximum(own[at] * self.own[mark], 1e-20))
            out[part[word], mark] = np.exp(SHARPNESS * (np.minimum(like, 1) - 1))
        return out


def bare(word: str) -> str:
    """The word without what is neither letter nor digit."""
    return word if word.isalnum() else "".join(c for c in word if c.isalnum())


def inserted(word: str) -> list[str]:
    """The word with a letter put between any two of its letters."""
    return [word[:k] + "x" + word[k:] for k in range(1, len(word))]


def pieces(word: str) -> list[str]:
    if len(word) <= WIDTH:
        return [word]
    return [word[k:k + WIDTH] for k in range(0, len(word) - WIDTH // 2, WIDTH // 2)]


# ---- words of texts --------------------------------------------------------
def _clean(data: bytes) -> str:
    return data.decode("utf-8", "replace").strip(_EDGE)


def _spaced(w: ws.Words) -> Iterator[tuple[int, str]]:
    """(text, word) of runs of three and more single letters."""
    width = w.stop - w.start
    lead = w.data[w.start] if len(w.start) else np.zeros(0, np.uint8)
    single = ((width == 1) & ws.LETTER[lead]) | ((width == 2) & (lead >= 0xC2))
    if not single.any():
        return
    text = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    joined = np.zeros(len(single), bool)
    joined[1:] = single[1:] & single[:-1] & (text[1:] == text[:-1])
    begin = np.flatnonzero(single & ~joined)
    end = np.append(begin[1:], len(single))
    for a, stop in zip(begin.tolist(), end.tolist()):
        b = a + 1
        while b < stop and joined[b]:
            b += 1
        if b - a >= 3:
            yield int(text[a]), b"".join(bytes(w.data[w.start[k]:w.stop[k]]) for k in range(a, b)).decode("utf-8", "replace")


def _distinct(w: ws.Words) -> tuple[list[int], list[bytes], np.ndarray]:
    """(hashes, bytes, place of each word's hash) of the distinct words of a block."""
    h, first, inverse = np.unique(w.hashes, return_index=True, return_inverse=True)
    raw = w.data.tobytes()
    return h.tolist(), [raw[a:b] for a, b in zip(w.start[first].tolist(), w.stop[first].tolist())], inverse


# ---- model -----------------------------------------------------------------
@dataclass
class Model:
    landmarks: Landmarks | None  # None without evidence
    weights: np.ndarray   # on the kernels to the landmarks (embedding and machine in one)
    bias: float
    slope: float = 1.0    # of the calibration
    offset: float = 0.0
    share: float = 0.5    # score without evidence

    def margins(self, words: list[str]) -> np.ndarray:
        """Decision values; a word of several pieces has its strongest one's, a word with
        punctuation inside that of its letters alone if it is higher."""
        if not words:
            return np.zeros(0)
        cut = [pieces(x) if (b := bare(x)) == x or not b else pieces(x) + pieces(b) for x in words]
        if all(len(x) == 1 for x in cut):
            return self.landmarks.kernel(words) @ self.weights + self.bias
        flat = self.landmarks.kernel([p for x in cut for p in x]) @ self.weights + self.bias
        at = np.concatenate([[0], np.cumsum([len(x) for x in cut])[:-1]])
        return np.maximum.reduceat(flat, at)

    def scores(self, margins: np.ndarray) -> np.ndarray:
        if self.landmarks is None:
            return np.full(len(margins), self.share)
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -30, 30)))


_MEMO: dict[str, dict[int, float]] = {}


def text_margins(w: ws.Words, model: Model, memo: dict[int, float]) -> np.ndarray:
    """Strongest decision value in each text of a block."""
    out = np.full(len(w.first) - 1, model.bias)
    if len(w.hashes):
        keys, raw, inverse = _distinct(w)
        new = [k for k, h in enumerate(keys) if h not in memo]
        if len(memo) + len(new) > MEMO:
            memo.clear()
            new = list(range(len(keys)))
        names: dict[str, list[int]] = {}
        for k in new:
            names.setdefault(_clean(raw[k]), []).append(keys[k])
        for values, value in zip(names.values(), model.margins(list(names)).tolist()):
            for h in values:
                memo[h] = value
        of_word = np.array([memo[h] for h in keys])[inverse]
        full = np.flatnonzero(np.diff(w.first))
        out[full] = np.maximum(out[full], np.maximum.reduceat(of_word, w.first[:-1][full]))
        spaced = list(_spaced(w))
        for (t, _), value in zip(spaced, model.margins([x for _, x in spaced])):
            out[t] = max(out[t], value)
    return out


def _machine(x: np.ndarray, y: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss (weights ``c``), by Newton steps with step halving."""
    a = np.hstack([x, np.ones((len(x), 1))])
    keep = np.diag([1.0] * x.shape[1] + [1e-3])
    v = np.zeros(a.shape[1])
    loss = lambda v: v @ keep @ v / 2 + (c * np.maximum(0, 1 - y * (a @ v)) ** 2).sum()
    for _ in range(50):
        short = 1 - y * (a @ v)
        on = short > 0
        grad = keep @ v - 2 * a[on].T @ (c[on] * y[on] * short[on])
        step = np.linalg.solve(keep + 2 * (a[on] * c[on, None]).T @ a[on], grad)
        size = 1.0
        while size > 1e-4 and loss(v - size * step) > loss(v):
            size /= 2
        v = v - size * step
        if np.abs(step).max() * size < 1e-6:
            break
    return v[:-1], float(v[-1])


def fit_words(landmarks: list[str], toxic: dict[str, float], clean: dict[str, float]) -> Model:
    """Machine that separates weighted toxic words, also with a letter inserted, from clean ones."""
    grown = dict(toxic)
    for w, weight in toxic.items():
        if len(w) > ORDER:
            for m in inserted(w):
                if m not in clean:
                    grown.setdefault(m, 2 * weight)
    words = [*grown, *clean]
    y = np.array([1.0] * len(grown) + [-1.0] * len(clean))
    c = np.array([*grown.values(), *clean.values()])
    for side in (y > 0, y < 0):
        c[side] *= COST * side.sum() / max(c[side].sum(), 1e-9)
    marks = Landmarks(landmarks)
    value, vector = np.linalg.eigh(marks.kernel(landmarks).astype(float))
    use = value > 1e-3 * value.max()
    embed = vector[:, use] / np.sqrt(value[use])
    w, bias = _machine(marks.kernel(words) @ embed, y, c)
    return Model(marks, embed @ w, bias)


def _spread(words: list[str], n: int) -> list[str]:
    """The first words of the list that are not much alike."""
    out: list[str] = []
    for w in words[:40 * n]:
        if len(out) < n and len(w) >= ORDER and (not out or Landmarks(out).kernel([w]).max() < 0.6):
            out.append(w)
    return out


def _calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic fit of labels on margins (smoothed targets, increasing)."""
    t = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    a = np.stack([margin, np.ones(len(y))], axis=1)
    v = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ v, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.eye(2) * 1e-3, a.T @ (p - t) + 1e-3 * (v - [1, 0]))
        v = v - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return max(float(v[0]), 0.05), float(v[1])


# ---- training on tables ----------------------------------------------------
def _sample(docs: DataFrame, labels: DataFrame, usable: Column, label: str) -> DataFrame:
    """(doc_id, text, y) of the labelled sample; its size bound allows the broadcast."""
    known = labels.where(usable & F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(
        (F.max(label) > 0).cast("int").alias("y"))
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("y = 1").orderBy(*by_hash).limit(MAX_TOXIC).unionByName(
        known.where("y = 0").orderBy(*by_hash).limit(MAX_CLEAN))
    return one_text_an_id(docs.select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("text")).join(
        F.broadcast(chosen), "doc_id"), "y")


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: its copy group (smallest hash of five words) and its distinct words and beginnings."""
    for b in batches:
        for lo, hi, w in ws.blocks(b.column(1)):
            at, h = w.windows(5)
            for t in range(hi - lo):
                a, z = int(w.first[t]), int(w.first[t + 1])
                inside = (at >= a) & (at < z) if z - a >= 5 else np.zeros(0, bool)
                group = int(h[inside].min() if inside.any() else w.hashes[a:z].min(initial=0)) >> 1
                words = {_clean(bytes(w.data[w.start[k]:w.stop[k]]))[:WIDTH] for k in range(a, z)} - {""}
                begin = {x[:n] for x in words for n in range(PREFIX[0], min(PREFIX[1], len(x)) + 1)}
                units = sorted(words | begin)
                y = b.column(2)[lo + t].as_py()
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([b.column(0)[lo + t].as_py()] * len(units)).cast(b.schema.field(0).type),
                    "grp": pa.array([group] * len(units), pa.int64()), "y": pa.array([y] * len(units), pa.int32()),
                    "unit": pa.array(units, pa.string()), "word": pa.array([u in words for u in units], pa.bool_())})


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic") -> Model:
    """Fit on the labelled documents for which ``usable`` (a condition on ``labels``) holds."""
    sample = written(_sample(docs, labels, usable, label), "toxicity-sample")
    kind = docs.schema["doc_id"].dataType.simpleString()
    units = written(sample.select("doc_id", "text", "y").mapInArrow(
        _units, f"doc_id {kind}, grp long, y int, unit string, word boolean"), "toxicity-units")
    first = units.groupBy("grp", "y").agg(F.min("doc_id").alias("doc_id"))  # near copies count once
    size = {r.y: r.n for r in first.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    p, n = size.get(1, 0), size.get(0, 0)
    share = (p + 0.5) / (p + n + 1)
    if not p or not n:
        return Model(None, np.zeros(0), 0.0, share=share)
    counts = written(units.join(F.broadcast(first.select("doc_id")), "doc_id", "left_semi").groupBy("unit").agg(
        F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"), F.max("word").alias("word")), "toxicity-counts")
    q, both = p / (p + n), F.col("pos") + F.col("neg")
    part = lambda c, share: F.when(F.col(c) == 0, 0.0).otherwise(F.col(c) * F.log(F.col(c) / both / share))
    counts = counts.withColumn("ratio", F.when(F.col("pos") / both > q, part("pos", q) + part("neg", 1 - q)).otherwise(0.0))
    mostly = F.col("pos") > 4 * F.col("neg")
    strong = counts.where((F.col("ratio") >= EVIDENCE) & mostly).orderBy(
        F.desc("ratio"), F.desc(F.length("unit")), "unit").limit(4000)
    found = {r.unit for r in strong.collect()}
    # witnesses: words of toxic texts that are evidence or begin like evidence
    begins = F.explode(F.array_distinct(F.concat(F.array("unit"), F.transform(
        F.sequence(F.lit(PREFIX[0]), F.lit(PREFIX[1])), lambda k: F.substring(F.col("unit"), F.lit(1), k)))))
    words = counts.where("word").where(mostly & (F.length("unit") >= ORDER))
    witness = words.withColumn("begin", begins).join(
        F.broadcast(strong.select(F.col("unit").alias("begin"))), "begin", "left_semi").dropDuplicates(["unit"])
    toxic = {r.unit: float(r.pos) for r in witness.orderBy(F.desc("pos"), "unit").limit(MAX_WITNESSES).collect()}
    landmarks = list(toxic)[:LANDMARKS]
    if not landmarks:
        return Model(None, np.zeros(0), 0.0, share=share)
    usual = counts.where(F.col("word") & (F.col("neg") > 0) & ~mostly)
    clean = {r.unit: float(r.neg) ** 0.5 for r in usual.orderBy(F.xxhash64("unit")).limit(SAMPLED_WORDS).collect()}
    model = fit_words(landmarks, toxic, clean)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def worst(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = shared.value.margins(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(m, pa.float64())], names=["unit", "margin"])

    hard = usual.select("unit", "neg").join(usual.select("unit").mapInArrow(
        worst, "unit string, margin double").orderBy(F.desc("margin"), "unit").limit(HARD_WORDS), "unit").orderBy(
        F.desc("margin"), "unit").collect()
    clean |= {r.unit: 4 * float(r.neg) ** 0.5 for r in hard}
    model = fit_words([*landmarks, *_spread([r.unit for r in hard], CLEAN_LANDMARKS)], toxic, clean)
    seen = _margins(sample, model, ["y"]).collect()
    margin, y = np.array([r.margin for r in seen]), np.array([float(r.y) for r in seen])
    model.slope, model.offset = _calibrate(margin, y)
    # even odds where nine tenths of the strongest witnesses' forms with a letter inserted are found, but above clean texts
    forms = model.margins([m for w in landmarks[:STRONGEST] if len(w) > ORDER for m in inserted(w)])
    if len(forms) and (y == 0).any():
        even = max(np.quantile(forms, 0.1), np.quantile(margin[y == 0], 0.995))
        model.offset = max(model.offset, -model.slope * float(even))
    return model


def _margins(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``margin`` of the lower-case texts in column ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some dozen strings and numbers
    src = docs.select(*keep, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = repr((shared.value.landmarks.names, shared.value.weights.tolist(), shared.value.bias))
        memo = _MEMO.setdefault(key, {})
        for b in batches:
            m = [text_margins(w, shared.value, memo) for _, _, w in ws.blocks(b.column(len(keep)))]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(np.concatenate(m) if m else np.zeros(0), pa.float64())],
                names=[*keep, "margin"])

    return src.mapInArrow(run, src.select(*keep, F.lit(0.0).alias("margin")).schema)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score): the probability that the text is toxic, for every row of ``docs`` (doc_id, text)."""
    low = docs.select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    if model.landmarks is None:
        return low.select("doc_id", F.lit(model.share).alias("score"))
    z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.lit(model.slope) * F.col("margin") + F.lit(model.offset)))
    return _margins(low, model, ["doc_id"]).select("doc_id", (1 / (1 + F.exp(-z))).alias("score"))
