"""Connected components of an edge table with DataFrame operations only.

Alternating large-star and small-star rounds: every round replaces edges by
edges towards the smallest neighbour, until the table is a set of stars. A
round is two aggregations (with partial aggregation, so that a hub costs
one row for each task) and two joins against those aggregates (one row a
key, so that adaptive skew splitting applies to hubs). Rounds are written
to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokewise.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("child", "parent"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", tag: str = "components") -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` can reach.

    Nodes are any orderable type. Edges with a null end and loops are dropped;
    repeated edges count once; nodes without an edge are not in the result.
    """
    x, y = F.col(f"`{a}`"), F.col(f"`{b}`")
    e = written(edges.where(x != y).select(F.greatest(x, y).alias("child"), F.least(x, y).alias("parent")).distinct(),
                tag)
    state = _state(e)
    while state[0]:
        both = e.union(e.select(F.col("parent").alias("child"), F.col("child").alias("parent")))
        low = both.groupBy("child").agg(F.min("parent").alias("m")).select(
            F.col("child").alias("u"), F.least("child", "m").alias("m"))
        # large star: neighbours above u go to the smallest of u and its neighbours
        large = (e.join(low, F.col("parent") == F.col("u")).select("child", F.col("m").alias("parent")).distinct())
        low2 = large.groupBy("child").agg(F.min("parent").alias("m")).withColumnRenamed("child", "u")
        # small star: the parents of u, and u itself, go to the smallest parent
        joined = large.join(low2, F.col("child") == F.col("u"))
        small = joined.select(F.col("parent").alias("child"), F.col("m").alias("parent")).where("child != parent").union(
            low2.select(F.col("u").alias("child"), F.col("m").alias("parent"))).distinct()
        e = written(small, tag)
        state, before = _state(e), state
        if state == before:
            break
    return e.select(F.col("child").alias("node"), F.col("parent").alias("component")).union(
        e.select(F.col("parent").alias("node"), F.col("parent").alias("component")).distinct())
