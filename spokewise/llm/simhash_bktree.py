"""SimHash near-dedup with BK-trees.

A document's fingerprint is the bitwise majority of the hashes of its word
shingles. Equal fingerprints are folded first, so groups of copies of any
size become one row. The distinct fingerprints are dealt to shards: the 64
bits are cut into ``radius + 2`` blocks, two fingerprints within the radius
agree on at least two of them, and a shard holds the fingerprints with the
same values in one such pair of blocks. Inside a shard a BK-tree (children
keyed by their integer Hamming distance to the parent) is searched and
grown; only edges whose key lies within the radius of the distance at the
parent are followed.

The trees of all shards together grow with the corpus, so they are not
broadcast through the driver: a shard's tree is built in the task that
receives the shard, where all its queries are too. A shard of over
``SPLIT`` fingerprints is dealt again by pairs of blocks of its remaining
bits; what is left free after that are few bits (16 for radius 2), which
bounds a shard (65,536 fingerprints) whatever the data. Out of a shard come
only links from a fingerprint to its group's first one, never all pairs.

Defined results: null and blank texts have fingerprint zero and link like
any other; null ids are kept as rows (a component's id is the smallest
non-null id in it, null if there is none); repeated rows give repeated
results; extra columns of the input are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spokewise.llm.blocks import block_keys
from spokewise.llm.common import written
from spokewise.llm.components import connected_components

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))  # A-Z to a-z
SPLIT = 4096       # fingerprints from which on a shard is dealt again
_STEP = 1 << 16    # shingles hashed at a time


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash (unsigned): bit set if set in over half of the shingles' XXH64; zero without words."""
    words = (text or "").encode().translate(LOWER).split()  # bytes.split() cuts at exactly space and 0x09-0x0D
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _STEP):
        part = words[at:min(n, at + _STEP) + shingle - 1]
        runs = zip(*(part[k:] for k in range(shingle))) if len(part) >= shingle else [part]
        h = np.array([xxhash.xxh64_intdigest(b" ".join(r), seed) for r in runs], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << k for k in np.flatnonzero(2 * ones > n).tolist())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3,
                 seed: int = 42) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    src = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("__text"))
    schema = src.select("doc_id", F.lit(0).cast("long").alias("fp")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [_signed(fingerprint(t.as_py(), shingle, seed)) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    return src.mapInArrow(run, schema)


class BKTree:
    """BK-tree of integers under Hamming distance."""

    def __init__(self, radius: int):
        self.radius = radius
        self.values: list[int] = []
        self.edges: list[dict[int, int]] = []  # distance to the parent -> child

    def add(self, value: int) -> list[int]:
        """Positions of the values within the radius of ``value``, which is then added."""
        found, values, edges, r = [], self.values, self.edges, self.radius
        if values:
            todo = [0]
            while todo:
                k = todo.pop()
                d = (value ^ values[k]).bit_count()
                if d <= r:
                    found.append(k)
                for key, child in edges[k].items():
                    if d - r <= key <= d + r:
                        todo.append(child)
            k = 0
            while True:
                d = (value ^ values[k]).bit_count()
                if d not in edges[k]:
                    edges[k][d] = len(values)
                    break
                k = edges[k][d]
        values.append(value)
        edges.append({})
        return found


def group_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links from values to the first value of their group, for groups of two and more."""
    tree, root = BKTree(radius), list(range(len(values)))

    def top(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for n, v in enumerate(values):
        for k in tree.add(v):
            x, y = top(k), top(n)
            root[max(x, y)] = min(x, y)
    return [(values[k], values[top(k)]) for k in range(len(values)) if top(k) != k]


def fingerprint_links(distinct: DataFrame, radius: int = 2, split: int = SPLIT) -> DataFrame:
    """(a, b) links between distinct fingerprints (column ``fp``) that connect all within ``radius`` bits."""
    parts = radius + 2
    every, fp = list(range(64)), F.col("fp")
    first = block_keys(fp, every, parts)
    dealt = distinct.select("fp", F.posexplode(F.array(*[k for k, _ in first])).alias("deal", "shard"))
    sizes = dealt.groupBy("deal", "shard").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    dealt = dealt.join(sizes, ["deal", "shard"])
    again = F.lit(None)
    for n, (_, free) in enumerate(first):
        again = F.when(F.col("deal") == n, F.array(*[k for k, _ in block_keys(fp, free, parts)])).otherwise(again)
    dealt = dealt.select("fp", "deal", "shard", F.explode(
        F.when(F.col("n") > split, again).otherwise(F.array(F.lit(-1).cast("long")))).alias("sub"))
    src = dealt.repartition("deal", "shard", "sub").sortWithinPartitions("deal", "shard", "sub", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None  # the shard that may go on in the next batch
        for b in batches:
            links = []
            cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("deal", "shard", "sub", "fp")]
            for *now, v in zip(*cols):
                if now != key:
                    links += group_links(held, radius) if len(held) > 1 else []
                    held, key = [], now
                held.append(v & (1 << 64) - 1)
            yield _batch(links)
        yield _batch(group_links(held, radius) if len(held) > 1 else [])

    return src.mapInArrow(run, "a long, b long")


def _batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([_signed(x[k]) for x in links], pa.int64()) for k in (0, 1)],
                                      names=["a", "b"])


def components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3,
               radius: int = 2) -> DataFrame:
    """(doc_id, fp, component_id): one row per document; documents linked by fingerprints within
    ``radius`` bits, directly or over others, share the smallest id among them."""
    fps = written(fingerprints(docs, text, doc_id, shingle), "simhash")
    distinct = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    links = written(fingerprint_links(distinct, radius), "simhash-links")
    comp = connected_components(links, tag="simhash-components")
    root = F.coalesce("component", "fp")
    named = distinct.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", root.alias("root"))
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # written first: the join below then reads two plain tables, and a hot fingerprint can be split
    named = written(named.join(ids, "root").select("fp", "component_id"), "simhash-named")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: str = "fp") -> Column:
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


def keep_first(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3,
               radius: int = 2) -> DataFrame:
    """One row of ``docs`` of each group: with the smallest id, of several texts with that id the one with the least hash, of
    repeated rows one. Rows with a null id are kept: they cannot be told apart."""
    no_id = F.col(f"`{doc_id}`").isNull()
    # the id alone does not tell rows apart: another text with it may be in another group
    keyed = docs.withColumn("__key", F.struct(F.col(f"`{doc_id}`").alias("id"), F.xxhash64(F.coalesce(
        F.col(f"`{text}`"), F.lit(""))).alias("hash")))
    rows = keyed.where(~no_id)
    first = components(rows, text, "__key", shingle, radius).where("doc_id = component_id").select(
        F.col("doc_id").alias("__keep")).distinct()
    ided = rows.join(first, F.col("__key") == F.col("__keep"), "left_semi").dropDuplicates(["__key"])
    return ided.unionByName(keyed.where(no_id)).drop("__key")
