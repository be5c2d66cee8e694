"""Pitman-Yor scores against a plain version with dictionaries, and the seating against its definition."""

import math
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from spokewise.llm import packing, pitman_yor, queries
from tests.conftest import SF_SMALL
from tests.llm import edge



def held_column():
    return F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % 5 == 1


def is_held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def tokens_of(text):
    ascii_lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*edge.words(ascii_lower), " end"]


def key(word):
    return xxhash.xxh3_64_intdigest(word.encode())


def counted(rows):
    train = [tokens_of(t) for i, t in rows if not is_held(i)]
    pairs = Counter(p for d in train for p in zip([" start", *d], d, strict=False))
    return train, pairs, Counter(w for d in train for w in d)


class Plain:
    """The model of one shard and one range, seats drawn with the same seeds."""

    def __init__(self, rows):
        train, self.pairs, self.words = counted(rows)
        everything = [tokens_of(t) for _, t in rows]
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.context = Counter(u for (u, _), c in self.pairs.items() for _ in range(c))
        contexts = sorted({u for d in everything for u in [" start", *d[:-1]]}, key=key)
        words = sorted({w for d in everything for w in d}, key=key)
        seen = sorted(self.pairs, key=lambda p: (key(p[0]), key(p[1])))
        place_c, place_w = {u: i for i, u in enumerate(contexts)}, {w: i for i, w in enumerate(words)}
        samples = pitman_yor.sample(
            np.array([place_c[u] for u, _ in seen], int), np.array([place_w[w] for _, w in seen], int),
            np.array([self.pairs[p] for p in seen], int), np.ones(len(contexts)),
            np.random.default_rng([pitman_yor.SEED, 0]))
        rng = np.random.default_rng([pitman_yor.SEED, 1 << 40, 0])
        d0, s0 = pitman_yor.ROOT
        self.samples = []
        for t in samples:
            tables = dict(zip(seen, t.tolist(), strict=True))
            of_word, of_context = defaultdict(int), defaultdict(int)
            for (u, w), k in tables.items():
                of_word[w] += k
                of_context[u] += k
            dishes = sorted(of_word, key=key)
            root = pitman_yor.seat(np.array([of_word[w] for w in dishes], int),
                                   np.full(len(dishes), (s0 + d0 * self.v) / (self.v + 1)), d0, rng)
            self.samples.append((tables, of_word, of_context, dict(zip(dishes, root.tolist(), strict=True))))

    def p(self, u, w):
        (d, s), (d0, s0) = pitman_yor.LEAF, pitman_yor.ROOT
        out = []
        for tables, of_word, of_context, root in self.samples:
            parent = ((of_word.get(w, 0) - d0 * root.get(w, 0) + (s0 + d0 * sum(root.values())) / (self.v + 1))
                      / (s0 + sum(of_word.values())))
            out.append((self.pairs.get((u, w), 0) - d * tables.get((u, w), 0)
                        + (s + d * of_context.get(u, 0)) * parent) / (s + self.context.get(u, 0)))
        return sum(out) / len(out)

    def row(self, doc_id, text):
        t = tokens_of(text)
        base = sum(math.log10((self.words.get(w, 0) + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in t)
        score = sum(math.log10(self.p(u, w)) for u, w in zip([" start", *t], t, strict=False))
        return doc_id, is_held(doc_id), len(t), sum(w in self.words for w in t), self.n, base, score


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[2:]))


def prose(n, seed=3):
    rng = np.random.default_rng(seed)
    vocabulary = [f"W{i}" for i in range(60)]
    p = 1 / np.arange(1, 61)
    return [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 40), p=p / p.sum()))) for i in range(n)]


@pytest.fixture()
def partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    yield lambda n: spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("rows", [prose(80), edge.ROWS], ids=["prose", "edge"])
def test_scores_against_plain_version(spark, partitions, rows):
    partitions(1)
    got = ordered(tuple(r) for r in pitman_yor.score(edge.edge_docs(spark, rows), held_column()).collect())
    plain = Plain(rows)
    want = ordered(plain.row(*r) for r in rows)
    assert len(got) == len(want) == len(rows)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)


def test_probabilities_add_up_to_one():
    plain = Plain(prose(60))
    for u in (" start", "w0", "w3", "never seen"):
        assert sum(plain.p(u, w) for w in [*plain.words, "unknown"]) == pytest.approx(1, abs=1e-9)


def test_many_shards_blocks_and_split_contexts(spark, partitions):
    """Counts are the same and the scores stay near those of one shard; a frequent word is a split context."""
    rows = [(i, t + " w0" * 30) for i, t in prose(300)]
    plain = Plain(rows)
    partitions(9)
    docs = edge.edge_docs(spark, rows).repartition(5)
    got = ordered(tuple(r) for r in pitman_yor.score(docs, held_column()).collect())
    want = ordered(plain.row(*r) for r in rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(g[5] == pytest.approx(w[5], rel=1e-9) for g, w in zip(got, want, strict=True))
    assert sum(g[6] for g in got) == pytest.approx(sum(w[6] for w in want), rel=0.06)     # small shards know few contexts


def test_split_contexts_are_dealt_by_the_next_word():
    contexts, words = np.full(1000, 7, np.uint64), np.arange(1000, dtype=np.uint64)
    alone = pitman_yor._shards(contexts, words, 64, (np.empty(0, np.uint64), np.empty(0, np.uint64)))
    assert len(set(alone.tolist())) == 1
    dealt = pitman_yor._shards(contexts, words, 64, (np.array([7], np.uint64), np.array([16], np.uint64)))
    assert 8 < len(set(dealt.tolist())) <= 16


def test_seating_follows_its_definition():
    """Mean numbers of tables against customers seated one at a time, also above the step to groups."""
    rng = np.random.default_rng(1)
    for count, weight, d in ((2, 0.7, 0.8), (40, 1.5, 0.5), (3000, 4.0, 0.3)):
        mine = pitman_yor.seat(np.full(400, count), np.full(400, weight), d, np.random.default_rng(2))
        one = np.ones(400)
        for m in range(1, count):
            one += rng.random(400) < weight / (weight + m - d * one)
        assert mine.mean() == pytest.approx(one.mean(), rel=0.06)
        assert mine.min() >= 1 and mine.max() <= count
    mixed = pitman_yor.seat(np.array([1, 5000, 1, 3]), np.full(4, 50.0), 0.1, rng)
    assert mixed[0] == mixed[2] == 1 and mixed[1] > 100 and 1 <= mixed[3] <= 3
    assert len(pitman_yor.seat(np.empty(0, int), np.empty(0), 0.5, rng)) == 0


def test_packing_round_trip():
    rng = np.random.default_rng(4)
    for a in (np.empty(0, int), np.array([0]), rng.integers(0, 300, 999), rng.integers(0, 2 ** 62, 50), np.arange(70_000)):
        (back,) = packing.unpack(packing.pack(a))
        assert (back == a).all() and len(back) == len(a)
    keys = np.unique(rng.integers(0, 2 ** 64, 1000, dtype=np.uint64))
    a, b = packing.unpack(packing.pack(packing.gaps(keys), np.arange(len(keys))))
    assert (packing.rising(a) == keys).all() and (b == np.arange(len(keys))).all()


def test_empty_table_untrained_and_learning(spark):
    empty = pitman_yor.score(edge.edge_docs(spark, []), held_column())
    assert empty.count() == 0 and empty.columns[0] == "doc_id"
    untrained = pitman_yor.score(edge.edge_docs(spark, prose(4)), F.lit(True)).collect()
    assert {(r.train_tokens, r.n_known) for r in untrained} == {(0, 0)}
    assert all(abs(r.score) < 1e-9 and abs(r.base_score) < 1e-9 for r in untrained)


def test_query_beats_single_words_on_held_out_texts(spark):
    out = queries.op13_pitman_yor(spark, SF_SMALL)
    assert dict(out.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint",
                                "train_tokens": "bigint", "base_score": "double", "score": "double"}
    held = out.where("held_out").agg(F.sum("score"), F.sum("base_score"), F.count("*")).first()
    assert held[2] > 20 and held[0] > 0.95 * held[1]


@pytest.mark.parametrize("placed", [False, True])
def test_pairs_of_a_block_take_bounded_memory(placed):
    """The distinct pairs as counted with a dictionary, in a bounded number of bytes a token."""
    rng = np.random.default_rng(5)
    keys = np.sort(np.append(rng.integers(1, 1 << 60, 4000, dtype=np.uint64), pitman_yor.START_KEY))
    lengths = np.array([1, 30_000, 69_999, 100_000])
    held = np.array([False, True, False, False])
    tokens = rng.integers(0, len(keys), lengths.sum()).astype(np.int32)
    tracemalloc.start()
    found = pitman_yor._pairs(keys, tokens, lengths, held, placed)
    peak = tracemalloc.get_traced_memory()[1] / len(tokens)
    tracemalloc.stop()
    want, start, at = {}, int(np.searchsorted(keys, pitman_yor.START_KEY)), 0
    for n, h in zip(lengths, held, strict=True):
        before = start
        for t in tokens[at:at + n].tolist():
            want[before, t] = want.get((before, t), 0) + (not h)
            before = t
        at += n
    assert list(zip(found.context.tolist(), found.word.tolist(), strict=True)) == sorted(want)
    assert found.count.tolist() == [want[k] for k in sorted(want)]
    if placed:
        assert (found.word[found.of_token] == tokens).all()
    assert peak < (60 if placed else 42), peak    # 65 with np.unique and its inverse
