"""Ordinals and string aggregates over a whole table's order, without one task that holds it (A10, O1).

A range partitioning orders the rows, each task numbers its own, and the
sizes of the tasks before (one number per task) are added. Pieces of the string
aggregate are then groups of a fixed number of neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spokewise.session import new_workdir


def with_ordinal(df: DataFrame, order: list[Column], name: str = "ordinal") -> DataFrame:
    """``row_number() over (order by ...)``; rows with equal order columns get consecutive numbers in any order.

    The dealt rows are written, so that counting and numbering see the same partitions.
    """
    spark = df.sparkSession
    by = [*order, F.col("_tie").asc()]     # many equal rows may be dealt to several tasks
    dealt = (df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*by)
             .withColumn("_part", F.spark_partition_id()))
    path = new_workdir(spark, "ordinal") + "/rows"
    dealt.write.parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path)
    before = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = before.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))  # a row per task
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*by))
    return (dealt.withColumn(name, place).join(before, "_part")
            .withColumn(name, F.col(name) + F.col("_before")).drop("_part", "_before", "_tie"))


def listagg_pieces(df: DataFrame, text: str, sep: str, per_piece: int = 100_000) -> DataFrame:
    """``listagg(text, sep) within group (order by text)`` as (piece, n, text): the aggregate is the pieces'
    text in the order of ``piece``, joined by ``sep``. NULL texts are left out. A piece has ``per_piece``
    texts, so no task holds the whole."""
    numbered = with_ordinal(df.select(F.col(text).alias("text")).where(F.col("text").isNotNull()), [F.col("text").asc()])
    piece = F.floor((F.col("ordinal") - 1) / per_piece).cast("long")
    return numbered.groupBy(piece.alias("piece")).agg(
        F.count(F.lit(1)).alias("n"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "text"))), lambda r: r["text"]), sep).alias(text))
