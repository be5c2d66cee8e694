"""Substring dedup by level-wise doubling of repeated word windows.

Two levels: windows of half the length (``window / 2`` words) first; only
where such a window is repeated is it extended to twice its length. At the
full length no candidate is left to extend.

Level 1 does not look at every half window. A full window is represented by
the smallest hash among its half windows (its anchor), which depends on the
window's words alone: a repeated full window has a repeated anchor. Full
windows that follow each other and share an anchor form a chunk (about six
windows), and only one row per chunk is shuffled, keyed by the anchor. In
the key's order a stream over each partition decides:

* a chunk with the same words as an earlier one: all its windows are removed;
* the first chunk of its kind, alone under its anchor: its windows are first;
* the first chunk of its kind under an anchor with other chunks: a candidate.

Level 2 extends the candidates' windows to the full length and keeps, of
each, the first occurrence. Since every later chunk of the same words is
already decided, candidates are one per kind and few.

Copies inside one batch are folded before the shuffle (the first of them
goes on, the rest are decided), so a passage in a third of all documents
costs one row for each batch and kind. Folded rows travel under a key of
their own document. Windows are compared by 64-bit hashes of their words.

Defined results: null and blank texts have no words; texts shorter than a
window keep all words; a window's order is (doc_id, start), a null id comes
first; of rows with the same id the places compare like those of one
document, and equal places (repeated rows) do not remove each other. Extra
columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokewise.llm import wordstream as ws
from spokewise.llm.common import written

WINDOW = 20
_FOLDED = 1       # a row that is decided already
_BATCH = 1 << 16  # rows of an output batch
_ROW = {"key": pa.int64(), "sub": pa.int64(), "doc": pa.int64(), "row": pa.int64(), "start": pa.int64(),
        "n": pa.int32(), "kind": pa.int32()}
_ROW_DDL = "key long, sub long, doc long, row long, start long, n int, kind int"


def _emit(cols: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    total = len(cols["doc"])
    for k in range(0, total, _BATCH):
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[c][k:k + _BATCH]).cast(_ROW[c]) for c in cols], names=list(cols))


def _fold(key, sub, doc, row, start, n) -> Iterator[pa.RecordBatch]:
    """Rows of a batch, with all but the first of equal (key, sub) marked as decided."""
    order = np.lexsort((start, doc, sub, key))
    key, sub, doc, row, start, n = (x[order] for x in (key, sub, doc, row, start, n))
    later, at = _later(key, sub, doc, start)
    # decided rows leave the hot key; their own document's hash spreads them
    key = np.where(later, ws.mix((row ^ start).astype(np.uint64)).astype(np.int64), key)
    return _emit({"key": key, "sub": sub, "doc": doc, "row": row, "start": start, "n": n,
                  "kind": np.where(later, _FOLDED, 0)})


def _later(key, sub, doc, start) -> tuple[np.ndarray, np.ndarray]:
    """(row follows an earlier place of its kind, position of its kind's first row) in sorted rows."""
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (sub[1:] != sub[:-1])
    at = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
    return (doc != doc[at]) | (start != start[at]), at


def _chunks(w: ws.Words, window: int) -> tuple[np.ndarray, ...]:
    """(text, start word, windows, anchor, hash of all words) of the chunks of a block."""
    half = window // 2
    at, h = w.windows(half)
    full, _ = w.windows(window)
    if not len(full):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    smallest = np.full(len(w.hashes), np.iinfo(np.uint64).max, np.uint64)
    smallest[at] = h
    view = np.lib.stride_tricks.sliding_window_view(smallest, window - half + 1)
    anchor = full + view[full].argmin(axis=1)
    text = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))[full]
    new = np.ones(len(full), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (np.diff(full) != 1)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(full)))
    begin = full[first]
    whole = ws.span_hash(w.hashes, begin, begin + n + window - 1, ws.WORD_BASE)
    return text[first], begin - w.first[text[first]], n, smallest[anchor[first]], whole


def _level1(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, row = b.column(0).to_numpy(), b.column(1).to_numpy()
            parts = []
            for lo, _, w in ws.blocks(b.column(2)):
                text, start, n, anchor, whole = _chunks(w, window)
                parts.append((anchor.view(np.int64), whole.view(np.int64), doc[lo + text], row[lo + text], start, n))
            if parts:
                yield from _fold(*(np.concatenate(x) for x in zip(*parts)))
    return run


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, sub, doc, start) -> removed rows (kind 1) and candidates (kind 2).

    Held over from batch to batch: the last kind's first place, and the only
    first row of the last key until a second kind under it turns up.
    """
    key = sub = place = None
    lone: dict | None = None  # the held row: nothing else under its key so far
    for b in batches:
        c = {x: b.column(b.schema.get_field_index(x)).to_numpy() for x in _ROW}
        done = c["kind"] == _FOLDED
        out = [{x: v[done] for x, v in c.items()}]
        c = {x: v[~done] for x, v in c.items()}
        if len(c["key"]):
            later, at = _later(c["key"], c["sub"], c["doc"], c["start"])
            if key == c["key"][0] and sub == c["sub"][0]:  # the last kind goes on: its first place is known
                same = at == 0
                later[same] = (c["doc"][same] != place[0]) | (c["start"][same] != place[1])
                fresh = ~later & ~same
                tie = same & ~later
            else:
                fresh, tie = ~later, np.zeros(len(later), bool)
            out.append({x: v[later] for x, v in c.items()} | {"kind": np.full(later.sum(), 1)})
            # first rows: candidates where their key has another kind; ties with a first row share its lot
            first = np.flatnonzero(fresh | tie)
            keys = c["key"]
            kinds = np.zeros(len(keys), bool)
            kinds[1:] = (keys[1:] == keys[:-1]) & (c["sub"][1:] != c["sub"][:-1])
            if key == keys[0] and sub != c["sub"][0]:
                kinds[0] = True
            group = np.cumsum(np.concatenate([[0], (keys[1:] != keys[:-1]).astype(np.int64)]))
            many = np.zeros(group[-1] + 1, bool)
            np.logical_or.at(many, group, kinds)
            if key == keys[0] and lone is None:
                many[0] = True  # its earlier rows were candidates
            pick = first[many[group[first]]]
            if lone is not None and key == keys[0] and many[0]:
                out.append(lone)
                lone = None
            if lone is not None and key != keys[0]:
                lone = None
            out.append({x: v[pick] for x, v in c.items()} | {"kind": np.full(len(pick), 2)})
            last = group == group[-1]
            if many[-1]:
                lone = None
            else:
                mine = first[last[first]]
                held = {x: v[mine] for x, v in c.items()} | {"kind": np.full(len(mine), 2)}
                lone = held if lone is None or key != keys[-1] else {
                    x: np.concatenate([lone[x], held[x]]) for x in held}
            if key != keys[-1] or sub != c["sub"][-1]:
                place = (c["doc"][at[-1]], c["start"][at[-1]])
            key, sub = keys[-1], c["sub"][-1]
        for o in out:
            yield from _emit({x: o[x] for x in ("doc", "row", "start", "n", "kind")})


_DECIDED = "doc long, row long, start long, n int, kind int"


def _decide(rows: DataFrame) -> DataFrame:
    rows = rows.repartition("key").sortWithinPartitions("key", "sub", "doc", "start")
    return rows.mapInArrow(_resolve, _DECIDED)


def _level2(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, row, spans = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(3)
            parts = []
            for lo, hi, w in ws.blocks(b.column(2)):
                mine = spans.slice(lo, hi - lo)
                code = mine.flatten().to_numpy()
                text = np.repeat(np.arange(hi - lo), mine.value_lengths().to_numpy())
                start, n = code >> 6, code & 63
                at = np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                text = np.repeat(text, n)
                place = at + w.first[text]
                h = ws.span_hash(w.hashes, place, place + window, ws.WORD_BASE).view(np.int64)
                parts.append((h, np.zeros(len(h), np.int64), doc[lo + text], row[lo + text], at,
                              np.ones(len(h), np.int64)))
            if parts:
                yield from _fold(*(np.concatenate(x) for x in zip(*parts)))
    return run


def _spans(rows: DataFrame) -> DataFrame:
    """One row per document: its (start, n) pairs as start * 64 + n."""
    code = F.shiftleft("start", 6).bitwiseOR(F.col("n").cast("long"))
    return rows.groupBy("doc", "row").agg(F.collect_list(code).alias("spans"))


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, gone, kept = [], [], []
            for text, spans in zip(b.column(2), b.column(3)):
                words = (text.as_py() or "").encode().split()  # cuts at exactly space and 0x09-0x0D
                n = len(words)
                removed = 0
                if spans.is_valid and n:
                    code = spans.values.to_numpy()
                    step = np.zeros(n + 1, np.int64)
                    np.add.at(step, code >> 6, 1)
                    np.add.at(step, (code >> 6) + (code & 63) + window - 1, -1)
                    keep = np.cumsum(step)[:n] == 0
                    removed = int(n - keep.sum())
                    if removed:
                        words = compress(words, keep.tolist())
                total.append(n)
                gone.append(removed)
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [b.column(4), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"])
    return run


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) per row of ``docs``: every word is removed that a window
    covers whose words also start earlier in the table."""
    if window % 2 or not 4 <= window <= 100:
        raise ValueError("window: an even number from 4 to 100")
    src = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    src = src.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")).alias("doc"),
                     F.xxhash64("text").alias("row"), "text", "doc_id")
    one = _decide(src.select("doc", "row", "text").mapInArrow(_level1(window), _ROW_DDL))
    one = written(one, "substring-level1")
    # one exchange of the texts serves both joins; the small side is hashed, so texts are not sorted
    dealt = src.repartition("doc", "row")
    todo = _spans(one.where("kind = 2"))
    two = dealt.select("doc", "row", "text", "doc_id").join(todo.hint("shuffle_hash"), ["doc", "row"]).select(
        "doc", "row", "text", "spans").mapInArrow(_level2(window), _ROW_DDL)
    gone = one.where("kind = 1").unionByName(_decide(two).where("kind = 1"))
    cut = dealt.join(_spans(gone).hint("shuffle_hash"), ["doc", "row"], "left").select(
        "doc", "row", "text", "spans", "doc_id")
    return cut.mapInArrow(_cut(window), cut.select(
        "doc_id", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"),
        F.lit("").alias("kept_text")).schema)


def kept_digest(kept_text: str = "kept_text"):
    return F.sha2(F.encode(F.col(kept_text), "UTF-8"), 256)
