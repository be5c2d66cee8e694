"""Sort orders with NULL as the largest value (T4)."""

from pyspark.sql import Column

from spokewise.functions._util import col


def asc_nulls_largest(c) -> Column:
    return col(c).asc_nulls_last()


def desc_nulls_largest(c) -> Column:
    return col(c).desc_nulls_first()
