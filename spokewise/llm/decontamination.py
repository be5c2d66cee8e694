"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared as sequences of lower-case words without ASCII
punctuation. An item of n words may differ from a passage in
``floor(max_error * n)`` word edits (insert, delete, replace). It is split
into one piece more than that, so in every passage within the budget at
least one piece stands unchanged. Tasks look up every window of a piece's
length in the table of piece hashes (vectorised, no shuffle: the documents
stay where they are), and Myers' bit-parallel algorithm verifies the words
around each hit exactly.

A character of a script that is written without blanks is a word by itself.

Different item texts are searched once each; ids meet the matches in a join
afterwards, so copies of an item cost nothing in the tasks. The texts travel
in slices of ``SLICE_BYTES`` bytes (a longer text is a slice of its own),
packed by a running sum over ranges of their hashes. Where there are several
slices, the matches of one are written and its broadcast is freed before the
next one is fetched; the documents are read once for each slice. So driver and
executors hold one slice at a time, whatever the size of the benchmark.

Defined results: null texts and items have no words and never match; the
budget of items of fewer than five words is 0, they are found word for word
(``min_words`` leaves shorter ones out); an item found several times in a
document gives one row, at its best place (smallest distance, then the
earliest); repeated items and documents give a row each; ids may have any
type, null included. Extra columns are ignored; empty tables give an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import StructField, StructType

from spokewise.llm import wordstream as ws
from spokewise.llm.common import written

MAX_ERROR = 0.2          # word edits for each word of an item: similarity 0.8
MIN_WORDS = 1            # shorter items are not searched
SLICE_BYTES = 16 << 20   # text of the items that one broadcast holds
_RANGES = 16             # ranges of hashes for each slice that the texts would fill
_FILTER = 1 << 16
_MATCH = "digest string, distance int, n_words int, start_word long, end_word long"


def myers(pattern: list[int], text: list[int]) -> tuple[int, int]:
    """(smallest edit distance of ``pattern`` to a part of ``text``, end of the earliest such part)."""
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << m - 1
    same: dict[int, int] = {}
    for k, x in enumerate(pattern):
        same[x] = same.get(x, 0) | 1 << k
    up, down, score = full, 0, m
    best, end = m, 0
    for j, x in enumerate(text):
        eq = same.get(x, 0)
        vertical = eq | down
        horizontal = (((eq & up) + up) ^ up) | eq
        more = down | (full & ~(horizontal | up))
        less = up & horizontal
        if more & top:
            score += 1
        elif less & top:
            score -= 1
        if score < best:
            best, end = score, j + 1
        more, less = more << 1 & full, less << 1 & full
        up, down = less | (full & ~(vertical | more)), more & vertical
    return best, end


def best_part(pattern: list[int], text: list[int]) -> tuple[int, int, int]:
    """(distance, start, end) of the part of ``text`` that is nearest to ``pattern``."""
    d, end = myers(pattern, text)
    if d == len(pattern):
        return d, 0, 0
    # backwards from the end, the nearest start
    back = text[:end][::-1]
    same, length = _prefix(pattern[::-1], back, d)
    return same, end - length, end


def _prefix(pattern: list[int], text: list[int], bound: int) -> tuple[int, int]:
    """(distance, length) of the shortest prefix of ``text`` within ``bound`` edits of ``pattern``."""
    row = list(range(len(pattern) + 1))
    if row[-1] <= bound:
        return row[-1], 0
    for j, x in enumerate(text, 1):
        diagonal, row[0] = row[0], j
        for k, y in enumerate(pattern, 1):
            diagonal, row[k] = row[k], min(diagonal + (x != y), row[k] + 1, row[k - 1] + 1)
        if row[-1] <= bound:
            return row[-1], j
    raise ValueError("no prefix within the bound")


class Index:
    """Pieces of the items of a slice, by their hash."""

    def __init__(self, ids: list, hashes: list[np.ndarray], max_error: float, min_words: int):
        self.ids, self.words, self.budget = [], [], []
        by_length: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for i, h in zip(ids, hashes):
            n = len(h)
            if n < min_words:
                continue
            errors = int(max_error * n + 1e-9)
            item = len(self.ids)
            self.ids.append(i)
            self.words.append(h.tolist())
            self.budget.append(errors)
            cut = [round(k * n / (errors + 1)) for k in range(errors + 2)]
            for a, b in zip(cut, cut[1:]):
                key = int(ws.span_hash(h, np.array([a]), np.array([b]), ws.WORD_BASE)[0])
                by_length.setdefault(b - a, {}).setdefault(key, []).append((item, a))
        self.lengths = []
        for length, table in sorted(by_length.items()):
            seen = np.zeros(_FILTER, bool)
            keys = np.array(sorted(table), np.uint64)
            seen[(keys % np.uint64(_FILTER)).astype(np.int64)] = True
            self.lengths.append((length, table, keys, seen))

    def matches(self, w: ws.Words) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(text, item, distance, start word, end word, budget) of the items in the texts of a block."""
        found: dict[tuple[int, int], set[int]] = {}
        for length, table, keys, seen in self.lengths:
            at, h = w.windows(length)
            maybe = seen[(h % np.uint64(_FILTER)).astype(np.int64)]
            at, h = at[maybe], h[maybe]
            hit = keys[np.minimum(np.searchsorted(keys, h), len(keys) - 1)] == h
            text = np.searchsorted(w.first, at[hit], "right") - 1
            for t, p, key in zip(text.tolist(), at[hit].tolist(), h[hit].tolist()):
                for item, offset in table[key]:
                    found.setdefault((t, item), set()).add(p - offset)
        for (t, item), starts in sorted(found.items()):
            pattern, errors = self.words[item], self.budget[item]
            lo, hi = int(w.first[t]), int(w.first[t + 1])
            best, done = None, lo
            for s in sorted(starts):
                a, b = max(lo, s - errors), min(hi, s + len(pattern) + errors)
                if best is not None and (best[0] == 0 or b <= done):
                    continue
                done = b
                d, x, y = best_part(pattern, w.hashes[a:b].tolist())
                if d <= errors and (best is None or d < best[0]):
                    best = (d, a + x - lo, a + y - lo)
            if best:
                yield t, item, *best, errors


def _words(texts: pa.Array) -> ws.Words | None:
    return next((w for _, _, w in ws.blocks(texts, ws.NOT_ALNUM, 1 << 62, singles=True)), None)


def _digest(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def _slices(texts: DataFrame, slice_bytes: int) -> list[Column]:
    """Conditions on the hash of ``text``, one for each slice.

    Only sizes come to the driver: some rows for each slice that the texts fill.
    """
    size = F.octet_length("text") + 64
    total = texts.agg(F.sum(size)).first()[0] or 0
    n = max(1, _RANGES * total // slice_bytes)
    part = F.pmod(F.xxhash64("text"), F.lit(n))
    if total <= slice_bytes:
        return [F.lit(True)]
    cuts, filled = [0], 0
    for r in texts.groupBy(part.alias("part")).agg(F.sum(size).alias("size")).orderBy("part").collect():
        if filled and filled + r["size"] > slice_bytes:
            cuts.append(r["part"])
            filled = 0
        filled += r["size"]
    return [(part >= a) & (part < b) for a, b in zip(cuts, [*cuts[1:], n])]


def _matches(docs: DataFrame, texts: DataFrame, max_error: float, min_words: int, slice_bytes: int) -> DataFrame:
    """(doc_id, digest, distance, n_words, start_word, end_word) of the different ``texts`` in ``docs``."""
    spark = docs.sparkSession
    src = docs.select("doc_id", F.lower(F.coalesce(F.col("text"), F.lit(""))).alias("text"))
    schema = StructType([StructField("doc_id", src.schema["doc_id"].dataType, True),
                         *StructType.fromDDL(_MATCH).fields])
    slices = _slices(texts, slice_bytes)
    found = None
    for wanted in slices:
        part = texts.where(wanted).select("text", _digest(F.col("text")).alias("digest")).collect()
        w = _words(pa.array([r.text for r in part], pa.string())) if part else None
        hashes = [w.hashes[a:b] for a, b in zip(w.first, w.first[1:])] if w else []
        index = spark.sparkContext.broadcast(Index([r.digest for r in part], hashes, max_error, min_words))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            x = index.value
            for b in batches:
                for lo, _, words in ws.blocks(b.column(1), ws.NOT_ALNUM, singles=True):
                    rows = [(lo + t, x.ids[i], d, len(x.words[i]), s, e) for t, i, d, s, e, _ in x.matches(words)]
                    if rows:
                        at, digest, *numbers = zip(*rows)
                        yield pa.RecordBatch.from_arrays(
                            [b.column(0).take(pa.array(at)), pa.array(digest),
                             *[pa.array(n, t) for n, t in zip(numbers, (pa.int32(), pa.int32(), pa.int64(), pa.int64()))]],
                            names=schema.names)

        hits = src.mapInArrow(run, schema)
        if len(slices) > 1:
            hits = written(hits, "item-matches")
            index.destroy()
        found = hits if found is None else found.unionByName(hits)
    return found


def _texts(items: DataFrame) -> DataFrame:
    """(text) of the different lower-case texts of the items, without null and empty ones."""
    return items.select(F.lower("text").alias("text")).where("text != ''").distinct()


def find_items(docs: DataFrame, items: DataFrame, max_error: float = MAX_ERROR, min_words: int = MIN_WORDS,
               slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(doc_id, item_id, distance, n_words, start_word, end_word): the items (item_id, text) that stand in
    the documents (doc_id, text) within their error budget."""
    hits = _matches(docs, _texts(items), max_error, min_words, slice_bytes)
    ids = items.where(F.col("text") != "").select("item_id", _digest(F.lower("text")).alias("digest"))
    return hits.join(ids, "digest").select("doc_id", "item_id", "distance", "n_words", "start_word", "end_word")


def remove_contaminated(docs: DataFrame, items: DataFrame, max_error: float = MAX_ERROR, min_words: int = MIN_WORDS,
                        slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The documents in which no item is found. Rows with a null id are searched by their own text."""
    key = F.struct(F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit("")))).alias("doc_id")
    keyed = docs.select(F.to_json(key).alias("doc_id"), "text")
    hit = _matches(keyed, _texts(items), max_error, min_words, slice_bytes).select("doc_id").distinct()
    return docs.withColumn("__key", F.to_json(key)).join(
        hit.withColumnRenamed("doc_id", "__key"), "__key", "left_anti").drop("__key")
