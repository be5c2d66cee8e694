"""Station upsert of the stream consumer.

``merge into bike_stations s using (... union ...) ns on s.station_id =
ns.station_id when not matched then insert`` has no UPDATE branch, so it
is an anti-join plus an append. Spark cannot MERGE into plain Parquet,
and no table-format package is installed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATION_COLS = ["station_id", "station_name", "station_latitude", "station_longitude", "station_comment"]


def _station(prefix: str):
    name = F.col(f"{prefix}_station_name")
    return F.struct(
        F.col(f"{prefix}_station_id").cast("int").alias("station_id"),
        name.alias("station_name"),
        F.col(f"{prefix}_station_latitude").cast("double").alias("station_latitude"),
        F.col(f"{prefix}_station_longitude").cast("double").alias("station_longitude"),
        F.concat(F.lit("Station at "), name).alias("station_comment"),
    )


def stations_union(trips: DataFrame) -> DataFrame:
    """UNION (distinct, NULLs equal) of the start and the end station of every trip.

    Written as one scan that emits both stations of a row, instead of two
    scans joined by a union; ``distinct`` is a partial + final aggregate,
    so each task ships at most one row per distinct station tuple.
    """
    both = trips.select(F.explode(F.array(_station("start"), _station("end"))).alias("s"))
    return both.select("s.*").distinct()


def merge_insert_only(target: DataFrame, source: DataFrame, key: str = "station_id") -> DataFrame:
    """Rows of ``source`` whose key has no match in ``target``: the rows MERGE inserts.

    The source is not deduplicated by key (T12): a station seen with two
    names yields two inserts, and a NULL key never matches, so it is
    inserted every time. The target side is reduced to its distinct keys.
    """
    keys = target.select(key).where(F.col(key).isNotNull()).distinct()
    return source.join(keys, on=key, how="left_anti").select(*source.columns)
