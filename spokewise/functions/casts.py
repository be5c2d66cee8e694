"""Casts with the dialect's rounding rule (T2): ``2.7::integer`` is 3, not 2."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from spokewise.functions._util import col


def cast_round(c, to: str = "int") -> Column:
    """Round half away from zero, then cast to an integral type."""
    return F.round(col(c)).cast(to)
