"""Earlier states of a table (D1, V1-V5, O3, P18) over ``VersionedTable``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokewise.operators.analytics import earliest_match
from spokewise.sources.tables import VersionedTable


def update_all(table: VersionedTable, column: str, value, now=None, text: str | None = None):
    """``update T set column = value`` without WHERE (D1): a new version, old ones stay."""
    df = table.read()
    dtype = df.schema[column].dataType
    new = df.withColumn(column, F.lit(value).cast(dtype))
    return table.replace(new, text or f"update {table.name} set {column} = {value!r}", op="update", now=now)


def first_statement_like(table: VersionedTable, pattern: str, latest: bool = False) -> str | None:
    """``select query_id from query_history where query_text like ... order by start_time limit 1``.

    The direction of the reference is kept (earliest of the matches, T15).
    The history holds one row per operation, so this reads metadata only.
    """
    row = earliest_match(table.history(), "query_text", pattern, "start_time", latest).first()
    return row["query_id"] if row else None


def version_counts(table: VersionedTable, column: str) -> DataFrame:
    """(version, row_count, n_values) of every version: its rows and different values of ``column`` (V1).

    Every segment is scanned once, whatever the number of versions that hold it: rows are counted by
    (segment, value), and only these counts meet the versions. Versions without rows count 0.
    """
    each = table.read_segments().groupBy("segment", F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    spans = table.lifetimes().select("segment", F.explode(F.sequence("added", F.col("removed") - 1)).alias("version"))
    per = each.join(spans, "segment").groupBy("version", "value").agg(F.sum("n").alias("n"))
    per = per.groupBy("version").agg(F.sum("n").alias("row_count"), F.count("value").alias("n_values"))
    return table.history().select("version").join(per, "version", "left").select(
        "version", F.coalesce("row_count", F.lit(0).cast("bigint")).alias("row_count"),
        F.coalesce("n_values", F.lit(0).cast("bigint")).alias("n_values"))
