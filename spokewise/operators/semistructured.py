"""Schema-on-read over a VARIANT column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spokewise.functions import vget
from spokewise.functions._util import ntz_lit



def v_int(v: str, path: str, lenient: bool = False) -> Column:
    """``v:path::int``: numeric value rounded, not truncated (T2), through decimal so that large
    integers keep their digits; lenient: what does not fit is NULL."""
    rounded = F.round(vget(v, path, "decimal(38,9)", lenient))
    return rounded.try_cast("int") if lenient else rounded.cast("int")


def v_double(v: str, path: str, lenient: bool = False) -> Column:
    return vget(v, path, "double", lenient)


def v_string(v: str, path: str, lenient: bool = False) -> Column:
    return vget(v, path, "string", lenient)


def v_timestamp(v: str, path: str, lenient: bool = False) -> Column:
    """``v:path::timestamp`` where the value is ISO text or epoch seconds.

    Text is cast to TIMESTAMP_NTZ; a number is added to the epoch as
    microseconds, so neither path depends on the session zone. Written as
    one short-circuit ``coalesce``: the common case costs one lookup, and
    in strict mode a value that is neither raises instead of becoming NULL.
    """
    from_text = vget(v, path, "timestamp_ntz", True)
    num = vget(v, path, "double", True)
    from_num = F.timestamp_add("MICROSECOND", F.round(num * F.lit(1_000_000)).cast("bigint"),
                               ntz_lit("1970-01-01 00:00:00"))
    if lenient:
        return F.coalesce(from_text, from_num)
    text = vget(v, path, "string", True)
    fail = F.when(text.isNotNull(), F.raise_error(F.concat(F.lit("cannot cast to timestamp: "), text))
                  .cast("timestamp_ntz"))
    return F.coalesce(from_text, from_num, fail)


KELVIN = 273.15  # fixed value: 0 °C in kelvin


def weather_view(raw: DataFrame, city_id: int | None = 5128638, v: str = "v",
                 lenient: bool = False) -> DataFrame:
    """``json_weather_data_view``: 15 typed columns out of the weather document.

    The city filter applies to the extracted alias (T5), i.e. after the
    projection. Hot fields should be materialised as typed columns at
    ingest when they are filtered often: predicates on ``variant_get``
    are not pushed into the Parquet scan.
    """
    out = raw.select(
        v_timestamp(v, "time", lenient).alias("observation_time"),
        v_int(v, "city.id", lenient).alias("city_id"),
        v_string(v, "city.name", lenient).alias("city_name"),
        v_string(v, "city.country", lenient).alias("country"),
        v_double(v, "city.coord.lat", lenient).alias("city_lat"),
        v_double(v, "city.coord.lon", lenient).alias("city_lon"),
        v_int(v, "clouds.all", lenient).alias("clouds"),
        (v_double(v, "main.temp", lenient) - F.lit(KELVIN)).alias("temp_avg"),
        (v_double(v, "main.temp_min", lenient) - F.lit(KELVIN)).alias("temp_min"),
        (v_double(v, "main.temp_max", lenient) - F.lit(KELVIN)).alias("temp_max"),
        v_string(v, "weather[0].main", lenient).alias("weather"),
        v_string(v, "weather[0].description", lenient).alias("weather_desc"),
        v_string(v, "weather[0].icon", lenient).alias("weather_icon"),
        v_double(v, "wind.deg", lenient).alias("wind_dir"),
        v_double(v, "wind.speed", lenient).alias("wind_speed"),
    )
    if city_id is not None:
        out = out.where(F.col("city_id") == F.lit(city_id))
    return out


def trip_fields(raw: DataFrame, v: str = "v", lenient: bool = False) -> DataFrame:
    """``push_trips`` projection (T-7): the bike_trips columns out of a trip document."""
    return raw.select(
        v_int(v, "tripduration", lenient).alias("tripduration"),
        v_timestamp(v, "starttime", lenient).alias("starttime"),
        v_timestamp(v, "stoptime", lenient).alias("stoptime"),
        v_int(v, "start_station_id", lenient).alias("start_station_id"),
        v_int(v, "end_station_id", lenient).alias("end_station_id"),
        v_int(v, "bikeid", lenient).alias("bikeid"),
        v_string(v, "usertype", lenient).alias("usertype"),
    )
