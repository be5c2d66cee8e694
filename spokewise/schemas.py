"""Table schemas (FIXTURES.md §1). Explicit StructTypes; schema inference is never used."""

from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampNTZType,
)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


I, D, S, L, TS = IntegerType(), DoubleType(), StringType(), LongType(), TimestampNTZType()

TRIPS = _s(
    ("tripduration", I), ("starttime", TS), ("stoptime", TS),
    ("start_station_id", I), ("start_station_name", S),
    ("start_station_latitude", D), ("start_station_longitude", D),
    ("end_station_id", I), ("end_station_name", S),
    ("end_station_latitude", D), ("end_station_longitude", D),
    ("bikeid", I), ("membership_type", S), ("usertype", S),
    ("birth_year", I), ("gender", I),
)

TRIPS_STREAM = _s(
    ("tripduration", I), ("starttime", TS), ("stoptime", TS),
    ("start_station_id", I), ("end_station_id", I), ("bikeid", I),
    ("usertype", S), ("birth_year", I), ("gender", I), ("program_id", I),
)

BIKE_TRIPS = _s(
    ("tripduration", I), ("starttime", TS), ("stoptime", TS),
    ("start_station_id", I), ("end_station_id", I), ("bikeid", I), ("usertype", S),
)

BIKE_STATIONS = _s(
    ("station_id", I), ("station_name", S), ("station_latitude", D),
    ("station_longitude", D), ("station_comment", S),
)

TESTTABLE = _s(("col1", I), ("col2", S))

# Keys of the trip JSON document (FIXTURES.md §1.4), in document order.
TRIP_DOC_KEYS = [
    "tripduration", "starttime", "stoptime", "start_station_id", "start_station_name",
    "start_station_latitude", "start_station_longitude", "end_station_id", "end_station_name",
    "end_station_latitude", "end_station_longitude", "bikeid", "usertype",
]

LOAD_LEDGER = _s(
    ("table_name", S), ("stage_location", S), ("file_name", S), ("last_load_time", TS),
    ("row_parsed", L), ("row_count", L), ("error_count", L), ("first_error", S), ("status", S),
)

RUN_LOG = _s(
    ("name", S), ("batch_id", L), ("scheduled_time", TS), ("completed_time", TS),
    ("state", S), ("rows", L),
)



def all_string(schema: StructType) -> StructType:
    """Same column names, every type STRING: the tolerant CSV read."""
    return StructType([StructField(f.name, StringType(), True) for f in schema.fields])
