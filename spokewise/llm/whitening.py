"""Embedding whitening by weighted multiplicity covariance (operator 11).

Vectors become whole numbers ``x = floor(scale * c) + offset``. Equal x
vectors are grouped first; every later step sees each distinct vector once,
with the number of its rows as weight:

1. one pass sums ``weight * x`` exactly (whole numbers of any size);
2. one pass multiplies the centred vectors, ``sum w z z'`` with
   ``z = (n x - S) / n``: the numerator is exact, so centring loses nothing.
   A task adds up its own vectors in one matrix product and passes on the
   upper triangle; Spark adds the triangles by entry, so the driver gets one
   number per pair of dimensions, whatever the number of rows;
3. one pass projects each distinct vector on the leading unit eigenvectors
   and divides by the root of the eigenvalue; the covariance of the result is
   taken from what was written.

The rows then fetch the result of their vector. A vector that holds over a
thousandth of all rows is one of at most a thousand, so these are broadcast
and their rows are not shuffled; the other keys have at most a thousandth
of the rows each.

Defined results: rows whose vector is null, empty or holds a null or
non-finite entry are left out, as are vectors of another length than the
commonest (of equally common ones the largest). Null and repeated ids stay:
each row gets its components. A table without usable rows gives no rows.
There are ``min(components, dimensions)`` components; one without variance
(eigenvalue under 1e-12 of the largest, all of them where vectors are equal)
has a null ``whitened``, ``explained`` 0 where the trace is 0, and stays out of
``identity_error`` (0 if there is no other). ``deviation`` is an exact
decimal(38). Columns other than the id and the vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spokewise.llm.common import written
from spokewise.llm.vectors import commonest_length, finite, scaled

COMPONENTS = 8
NO_VARIANCE = 1e-12   # of the largest eigenvalue
HOT = 1000            # a vector with more than 1 / HOT of the rows is joined by broadcast
SLICE = 4096          # distinct vectors of a matrix product
OUT = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


@dataclass
class Model:
    """What the fit leaves: count, exact sums, eigenvalues (falling) and unit eigenvectors (columns)."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def _slices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            yield (part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims),
                   part.column("weight").to_numpy(zero_copy_only=False))


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


def _numerators(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n x - S``, exact: 64-bit where it fits, Python integers otherwise."""
    if n * _largest(x) + max(map(abs, sums)) < 2 ** 63:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (_numerators(x, n, sums) / n).astype(np.float64)


def _square_sums(d: np.ndarray) -> list[int]:
    """Exact sum of squares of each row."""
    if d.dtype == object or _largest(d) ** 2 * d.shape[1] >= 2 ** 63:
        d = d.astype(object)
    return [int(v) for v in (d * d).sum(axis=1)]


def fit(distinct: DataFrame, dims: int, components: int) -> Model:
    """Eigenvectors of the covariance of ``distinct`` (x, weight)."""

    def sums_of(batches):
        total = [0] * dims
        for x, w in _slices(batches, dims):
            if _largest(x) * int(w.sum()) >= 2 ** 63:
                x, w = x.astype(object), w.astype(object)
            total = [a + int(b) for a, b in zip(total, (x * w[:, None]).sum(axis=0), strict=True)]
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(dims), pa.int32()),
                                          "s": pa.array([Decimal(v) for v in total], pa.decimal128(38, 0))})

    n = int(distinct.agg(F.sum("weight")).first()[0])
    rows = distinct.mapInArrow(sums_of, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    sums = [int(r["s"]) for r in sorted(rows, key=lambda r: r["i"])]
    upper = np.triu_indices(dims)

    def products_of(batches):
        total = np.zeros((dims, dims))
        for x, w in _slices(batches, dims):
            z = _centred(x, n, sums)
            total += (z * w[:, None].astype(np.float64)).T @ z
        yield pa.RecordBatch.from_pydict({"i": pa.array(upper[0], pa.int32()), "j": pa.array(upper[1], pa.int32()),
                                          "v": pa.array(total[upper])})

    covariance = np.zeros((dims, dims))
    for r in distinct.mapInArrow(products_of, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        covariance[r["i"], r["j"]] = covariance[r["j"], r["i"]] = r["v"] / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    return Model(n, sums, values[order], vectors[:, order], float(np.trace(covariance)))


def _with_variance(model: Model) -> list[int]:
    return [k for k, e in enumerate(model.values) if e > 0 and e > NO_VARIANCE * model.values[0]]


def project(distinct: DataFrame, dims: int, model: Model) -> DataFrame:
    """Each distinct vector once: (x, weight, deviation, white)."""
    live = _with_variance(model)
    n, sums, count = model.n, model.sums, len(model.values)
    axes = model.vectors[:, live] / np.sqrt(model.values[live]) if live else np.zeros((dims, 0))

    def whitened(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                for x, w in _slices(iter([part]), dims):
                    d = _numerators(x, n, sums)
                    z = (d / n).astype(np.float64) @ axes
                    white = [[None] * count for _ in range(len(x))]
                    for row, got in zip(white, z.tolist(), strict=True):
                        for k, v in zip(live, got, strict=True):
                            row[k] = v
                    yield pa.RecordBatch.from_arrays(
                        [part.column("x"), pa.array(w, pa.int64()),
                         pa.array([Decimal(v) for v in _square_sums(d)], pa.decimal128(38, 0)),
                         pa.array(white, pa.list_(pa.float64()))], ["x", "weight", "deviation", "white"])

    return distinct.mapInArrow(whitened, "x array<long>, weight long, deviation decimal(38,0), white array<double>")


def identity_error(white: DataFrame, model: Model) -> float:
    """Largest absolute entry of the weighted covariance of ``white`` minus the identity."""
    live = _with_variance(model)
    if not live:
        return 0.0

    def mean_of(value: Column) -> Column:
        return F.sum(F.col("weight") * value) / F.lit(float(model.n))

    means = white.agg(*[mean_of(F.get("white", F.lit(k))).alias(f"m{k}") for k in live]).first()
    centred = {k: F.get("white", F.lit(k)) - F.lit(means[f"m{k}"]) for k in live}
    pairs = [(a, b) for a in live for b in live if a <= b]
    got = white.agg(*[mean_of(centred[a] * centred[b]).alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(abs(got[f"c{a}_{b}"] - (a == b)) for a, b in pairs)


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           scale: int = 1024, offset: int = 100_000) -> DataFrame:
    """A row per usable row and component: the id and the columns of ``OUT``."""
    spark = df.sparkSession
    rows = (df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(finite(F.col("v")))
            .select("id", scaled(F.col("v"), scale, offset).alias("x")))
    distinct = written(rows.groupBy("x").agg(F.count(F.lit(1)).alias("weight")), "whitening-distinct")
    dims = commonest_length(distinct, "x", F.col("weight"))
    id_type = df.schema[id_col].dataType.simpleString()
    if not dims:
        return spark.createDataFrame([], f"`{id_col}` {id_type}, {OUT}")
    distinct = distinct.where(F.size("x") == dims)
    model = fit(distinct, dims, min(components, dims))
    white = written(project(distinct, dims, model), "whitening-white")
    error = identity_error(white, model)

    keep = ["x", "deviation", "white"]
    hot = white.where(F.col("weight") > F.lit(model.n / HOT)).select(*keep)       # at most HOT rows
    cold = white.where(F.col("weight") <= F.lit(model.n / HOT)).select(*keep)
    rows = rows.where(F.size("x") == dims)
    tried = rows.join(F.broadcast(hot), "x", "left")
    joined = (tried.where(F.col("white").isNotNull()).select("id", "deviation", "white")
              .unionByName(tried.where(F.col("white").isNull()).select("id", "x").join(cold, "x")
                           .select("id", "deviation", "white")))
    explained = [float(v / model.trace) if model.trace > 0 else 0.0 for v in model.values]
    return joined.select("id", "deviation", F.posexplode("white").alias("k", "whitened")).select(
        F.col("id").alias(id_col), (F.col("k") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
        "deviation", "whitened", F.get(F.array(*map(F.lit, explained)), F.col("k")).alias("explained"),
        F.lit(float(error)).alias("identity_error"))
