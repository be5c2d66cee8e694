"""Vectors as whole numbers: which rows take part, scaled entries, the commonest length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """The vector is there, has an entry, and none of its entries is null, NaN or infinite."""
    whole = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & whole, F.lit(False))


def scaled(vector: Column, scale: int, offset: int = 0, bits: int = 62) -> Column:
    """``floor(scale * c) + offset`` of each entry, as long; null where the vector is not ``finite``.

    An entry that does not fit ``bits`` bits is an error.
    """
    fits = F.forall(vector, lambda c: F.abs(c.cast("double") * F.lit(float(scale))) < F.lit(float(2 ** bits)))
    whole = F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long") + F.lit(offset))
    too_large = F.raise_error(F.lit(f"a vector entry times {scale} does not fit {bits} bits"))
    return F.when(~finite(vector), F.lit(None)).when(fits, whole).otherwise(too_large)


def commonest_length(vectors: DataFrame, column: str, weight: Column) -> int:
    """The length that most vectors have (of equally common ones the largest); 0 without vectors."""
    top = (vectors.groupBy(F.size(column).alias("length")).agg(F.sum(weight).alias("rows"))
           .orderBy(F.desc("rows"), F.desc("length")).first())
    return top["length"] if top else 0
