"""Adapter views over the driver tables (FIXTURES.md §3).

The reference's own data (bike trips, weather documents) is not
available, so the trip and weather relations are derived from
``events``. Each adapter is written twice with the same formulas: as a
Spark DataFrame builder (what the library runs) and as DuckDB SQL text
(what the oracle runs). Only double arithmetic that is exact in IEEE
(+, *, /) is used, so both engines produce the same bits.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokewise.functions.jsonfn import JSON_OPTIONS

# fixed values: city ids and names of the weather documents
NYC_CITY_ID = 5128638
NYC_NAME, NYC_LAT, NYC_LON = "New York", 40.714272, -74.005966
BKN_CITY_ID = 5110302
BKN_NAME, BKN_LAT, BKN_LON = "Brooklyn", 40.6501, -73.9496


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- trips

def _station_cols(prefix: str, sid):
    sid = sid.cast("int")
    return [
        sid.alias(f"{prefix}_station_id"),
        F.concat(F.lit("Station "), sid.cast("string")).alias(f"{prefix}_station_name"),
        (F.lit(40.6) + sid.cast("double") * F.lit(0.01)).alias(f"{prefix}_station_latitude"),
        (F.lit(-74.0) + sid.cast("double") * F.lit(0.01)).alias(f"{prefix}_station_longitude"),
    ]


def trips_from_events(events: DataFrame) -> DataFrame:
    """16-column trips relation (FIXTURES.md §1.1) derived row by row from events."""
    dur = F.round(F.col("value") * F.lit(10.0)).cast("int")
    start_sid = F.col("user_id") % 20
    end_sid = F.col("event_id") % 17
    cols = [
        dur.alias("tripduration"),
        F.col("ts").alias("starttime"),
        F.timestamp_add("SECOND", dur, F.col("ts")).alias("stoptime"),
        *_station_cols("start", start_sid),
        *_station_cols("end", end_sid),
        F.col("user_id").cast("int").alias("bikeid"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("string"))
         .otherwise(F.lit("annual")).alias("membership_type"),
        F.col("event_type").alias("usertype"),
        (F.lit(1950) + F.col("user_id") % 50).cast("int").alias("birth_year"),
        (F.col("user_id") % 3).cast("int").alias("gender"),
    ]
    return events.select(*cols)


def v_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_events(table(spark, sf_dir, "events"))


def trips_stream_from_trips(trips: DataFrame) -> DataFrame:
    """10-column layout of the CSV pipe lab (FIXTURES.md §1.2)."""
    return trips.select(
        "tripduration", "starttime", "stoptime", "start_station_id", "end_station_id",
        "bikeid", "usertype", "birth_year", "gender",
        (F.col("start_station_id") + F.col("end_station_id")).cast("int").alias("program_id"),
    )


def _sql_station(prefix: str, sid: str) -> str:
    return (f"CAST({sid} AS INTEGER) AS {prefix}_station_id, "
            f"'Station ' || CAST(CAST({sid} AS INTEGER) AS VARCHAR) AS {prefix}_station_name, "
            f"CAST(40.6 AS DOUBLE) + CAST({sid} AS DOUBLE) * CAST(0.01 AS DOUBLE) AS {prefix}_station_latitude, "
            f"CAST(-74.0 AS DOUBLE) + CAST({sid} AS DOUBLE) * CAST(0.01 AS DOUBLE) AS {prefix}_station_longitude")


V_TRIPS_SQL = (
    "v_trips AS (SELECT "
    "CAST(round(value * CAST(10.0 AS DOUBLE)) AS INTEGER) AS tripduration, "
    "ts AS starttime, "
    "ts + to_seconds(CAST(round(value * CAST(10.0 AS DOUBLE)) AS BIGINT)) AS stoptime, "
    + _sql_station("start", "user_id % 20") + ", "
    + _sql_station("end", "event_id % 17") + ", "
    "CAST(user_id AS INTEGER) AS bikeid, "
    "CASE WHEN event_id % 7 = 0 THEN CAST(NULL AS VARCHAR) ELSE 'annual' END AS membership_type, "
    "event_type AS usertype, "
    "CAST(1950 + user_id % 50 AS INTEGER) AS birth_year, "
    "CAST(user_id % 3 AS INTEGER) AS gender "
    "FROM events)"
)

V_TRIPS_STREAM_SQL = (
    "v_trips_stream AS (SELECT tripduration, starttime, stoptime, start_station_id, end_station_id, "
    "bikeid, usertype, birth_year, gender, CAST(start_station_id + end_station_id AS INTEGER) AS program_id "
    "FROM v_trips)"
)


# ---------------------------------------------------------------- weather

def weather_fields(events: DataFrame) -> DataFrame:
    """The top-level fields of one weather document per event (FIXTURES.md §1.5), plus ``day``.

    Every event is an observation, so several observations share an hour
    and the hour join fans out (trap T22).
    """
    nyc = F.col("event_type") != F.lit("signup")
    temp = F.lit(250.0) + F.col("value") / F.lit(10.0)
    doc = F.struct(
        F.col("ts").alias("time"),
        F.struct(
            F.when(nyc, F.lit(NYC_CITY_ID)).otherwise(F.lit(BKN_CITY_ID)).alias("id"),
            F.when(nyc, F.lit(NYC_NAME)).otherwise(F.lit(BKN_NAME)).alias("name"),
            F.lit("US").alias("country"),
            F.struct(F.when(nyc, F.lit(NYC_LAT)).otherwise(F.lit(BKN_LAT)).alias("lat"),
                     F.when(nyc, F.lit(NYC_LON)).otherwise(F.lit(BKN_LON)).alias("lon")).alias("coord"),
        ).alias("city"),
        F.struct(F.least(F.col("user_id"), F.lit(100)).alias("all")).alias("clouds"),
        F.struct(temp.alias("temp"), (temp - F.lit(1.5)).alias("temp_min"),
                 (temp + F.lit(2.25)).alias("temp_max")).alias("main"),
        F.array(
            F.struct(F.col("event_type").alias("main"),
                     F.concat(F.col("event_type"), F.lit(" conditions")).alias("description"),
                     F.lit("01d").alias("icon")),
            F.struct(F.lit("haze").alias("main"), F.lit("light haze").alias("description"),
                     F.lit("50d").alias("icon")),
        ).alias("weather"),
        F.struct(F.col("value").alias("deg"), (F.col("value") / F.lit(20.0)).alias("speed")).alias("wind"),
    )
    return events.select(doc.alias("d"), F.date_format(F.to_date("ts"), "yyyy-MM-dd").alias("day")) \
        .select("d.*", "day")


WEATHER_KEYS = ["time", "city", "clouds", "main", "weather", "wind"]


def weather_doc(events: DataFrame) -> DataFrame:
    """One JSON weather document per event, as text column ``doc``."""
    f = weather_fields(events)
    return f.select(F.to_json(F.struct(*WEATHER_KEYS), JSON_OPTIONS).alias("doc"))


def json_weather_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather documents parsed in place from events (no storage); for tests."""
    return weather_doc(table(spark, sf_dir, "events")).select(F.parse_json("doc").alias("v"))


_WEATHER_TABLES: dict = {}
_WEATHER_LOCK = threading.Lock()


def json_weather_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``json_weather_data (v variant)``: weather JSON files staged from events and loaded.

    As in the reference, the documents are loaded once into a table with
    one VARIANT column, and views read the stored binary variant. Loaded
    once per application and data folder.
    """
    from pyspark.sql.types import StructField, StructType, VariantType

    from spokewise.plans.fixtures import write_weather_json
    from spokewise.session import new_workdir
    from spokewise.sources import loader

    key = (spark.sparkContext.applicationId, sf_dir)
    with _WEATHER_LOCK:
        t = _WEATHER_TABLES.get(key)
        if t is None or not t.exists():
            root = new_workdir(spark, "weather")
            write_weather_json(weather_fields(table(spark, sf_dir, "events")), f"{root}/stage")
            cat = loader.Catalog(spark, f"{root}/db")
            t = cat.table("json_weather_data")
            t.create_empty(StructType([StructField("v", VariantType(), True)]), "create table json_weather_data")
            loader.copy_into(cat, "json_weather_data", f"{root}/stage", None, "json", on_error="abort")
            _WEATHER_TABLES[key] = t
    return t.read()


# What the weather view must return, computed straight from events (oracle side).
V_WEATHER_SQL = (
    "v_weather AS (SELECT "
    "ts AS observation_time, "
    f"CASE WHEN event_type <> 'signup' THEN {NYC_CITY_ID} ELSE {BKN_CITY_ID} END AS city_id, "
    f"CASE WHEN event_type <> 'signup' THEN '{NYC_NAME}' ELSE '{BKN_NAME}' END AS city_name, "
    "'US' AS country, "
    f"CASE WHEN event_type <> 'signup' THEN CAST({NYC_LAT} AS DOUBLE) ELSE CAST({BKN_LAT} AS DOUBLE) END AS city_lat, "
    f"CASE WHEN event_type <> 'signup' THEN CAST({NYC_LON} AS DOUBLE) ELSE CAST({BKN_LON} AS DOUBLE) END AS city_lon, "
    "CAST(least(user_id, 100) AS INTEGER) AS clouds, "
    "(CAST(250.0 AS DOUBLE) + value / CAST(10.0 AS DOUBLE)) - CAST(273.15 AS DOUBLE) AS temp_avg, "
    "((CAST(250.0 AS DOUBLE) + value / CAST(10.0 AS DOUBLE)) - CAST(1.5 AS DOUBLE)) - CAST(273.15 AS DOUBLE) AS temp_min, "
    "((CAST(250.0 AS DOUBLE) + value / CAST(10.0 AS DOUBLE)) + CAST(2.25 AS DOUBLE)) - CAST(273.15 AS DOUBLE) AS temp_max, "
    "event_type AS weather, "
    "event_type || ' conditions' AS weather_desc, "
    "'01d' AS weather_icon, "
    "value AS wind_dir, "
    "value / CAST(20.0 AS DOUBLE) AS wind_speed "
    "FROM events)"
)


def with_ctes(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


__all__ = ["table", "v_trips", "trips_from_events", "trips_stream_from_trips",
           "json_weather_data", "json_weather_inline", "weather_doc", "V_TRIPS_SQL", "V_TRIPS_STREAM_SQL",
           "V_WEATHER_SQL", "with_ctes"]
