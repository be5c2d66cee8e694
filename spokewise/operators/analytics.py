"""Trip analytics.

All operators are declarative DataFrame plans: partial + final
HashAggregate around one Exchange, top-k as TakeOrderedAndProject.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokewise.functions._util import ntz_lit
from spokewise.functions import (
    asc_nulls_largest, cast_round, datediff_boundary, desc_nulls_largest, haversine,
    hour_floor, seconds_until,
)


def trips_per_hour(trips: DataFrame) -> DataFrame:
    """A1: hourly trip count, mean minutes, mean distance; ordered by hour."""
    dist = haversine("start_station_latitude", "start_station_longitude",
                     "end_station_latitude", "end_station_longitude")
    return (trips
            .groupBy(hour_floor("starttime").alias("date"))
            .agg(F.count(F.lit(1)).alias("num trips"),
                 (F.avg("tripduration") / F.lit(60)).alias("avg duration (mins)"),
                 F.avg(dist).alias("avg distance (km)"))
            .orderBy(asc_nulls_largest("date")))


def trips_per_weekday(trips: DataFrame) -> DataFrame:
    """A2: trips per 3-letter day name (T3), most first."""
    return (trips
            .groupBy(F.dayname("starttime").alias("day of week"))
            .agg(F.count(F.lit(1)).alias("num trips"))
            .orderBy(desc_nulls_largest("num trips"), asc_nulls_largest("day of week")))


def top_stations(trips: DataFrame, k: int = 20, station_col: str = "start_station_name") -> DataFrame:
    """A3/O2: the k stations with most rides; ties broken by name for determinism."""
    return (trips
            .groupBy(F.col(station_col).alias("station"))
            .agg(F.count(F.lit(1)).alias("rides"))
            .orderBy(desc_nulls_largest("rides"), asc_nulls_largest("station"))
            .limit(k))


def popular_routes(trips: DataFrame) -> DataFrame:
    """A4: trips per (start, end) pair and the mean boundary-minute duration, rounded."""
    mins = datediff_boundary("minute", "starttime", "stoptime")
    return (trips
            .groupBy("start_station_id", "end_station_id")
            .agg(F.count(F.lit(1)).alias("num_trips"),
                 cast_round(F.avg(mins), "int").alias("avg_duration_mins"))
            .orderBy(desc_nulls_largest("num_trips"),
                     asc_nulls_largest("start_station_id"), asc_nulls_largest("end_station_id")))


def weather_trip_counts(trips: DataFrame, weather_view: DataFrame) -> DataFrame:
    """Trips per weather condition, trips matched to observations by hour.

    The reference left-joins every trip to every observation of its hour
    and then counts pairs (T22). The same count is obtained without
    materialising the pairs: count trips per hour and observations per
    (hour, condition), join the two small hour-level aggregates, and sum
    the products. Both sides are reduced map-side before any shuffle, so
    a hot hour costs one partial-aggregate row per task, not a fan-out.
    The ``conditions is not null`` filter makes the outer join inner.
    """
    t = (trips.groupBy(hour_floor("starttime").alias("hour"))
         .agg(F.count(F.lit(1)).alias("n_trips")))
    w = (weather_view
         .select(hour_floor("observation_time").alias("hour"), F.col("weather").alias("conditions"))
         .where(F.col("conditions").isNotNull() & F.col("hour").isNotNull())
         .groupBy("hour", "conditions")
         .agg(F.count(F.lit(1)).alias("n_obs")))
    return (t.join(w, "hour", "inner")
            .groupBy("conditions")
            .agg(F.sum(F.col("n_trips") * F.col("n_obs")).alias("num_trips"))
            .orderBy(desc_nulls_largest("num_trips"), asc_nulls_largest("conditions")))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``select count(*)`` of several tables, one row per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def min_max_time(trips: DataFrame, now) -> DataFrame:
    """Earliest and latest start, and the smallest second distance from ``now``."""
    now_c = ntz_lit(now)
    return trips.agg(F.min("starttime").alias("min_starttime"),
                     F.max("starttime").alias("max_starttime"),
                     F.min(seconds_until(now_c, F.col("stoptime"))).alias("min_seconds_from_now"))


def sort_nulls_largest(df: DataFrame, by: str, descending: bool = False) -> DataFrame:
    """O1: sort with NULL as the largest value (T4)."""
    return df.orderBy(desc_nulls_largest(by) if descending else asc_nulls_largest(by))


def earliest_match(df: DataFrame, text_col: str, like: str, time_col: str,
                   latest: bool = False) -> DataFrame:
    """The earliest (or latest) row whose text matches a LIKE pattern.

    ``order by t limit 1`` planned as a single global min/max aggregate
    (``min_by`` over a struct), so no sort of the filtered rows is needed.
    """
    m = df.where(F.col(text_col).like(like))
    pick = F.max_by if latest else F.min_by
    row = m.agg(pick(F.struct(*[F.col(c) for c in df.columns]), F.col(time_col)).alias("r"))
    return row.where(F.col("r").isNotNull()).select("r.*")
