"""Properties: rewrites equal their literal forms, also under heavy key skew."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from spokewise.functions import datediff_boundary
from spokewise.operators import analytics as an
from spokewise.operators.semistructured import weather_view
from spokewise.plans.adapters import json_weather_inline, v_trips


def _pairs(trips, weather):
    """J1 by definition: every trip with every observation of its hour."""
    hour = lambda c: F.date_trunc("hour", c)
    return (trips.join(weather, hour(weather["observation_time"]) == hour(trips["starttime"]))
            .where(F.col("weather").isNotNull()).groupBy(F.col("weather").alias("conditions"))
            .agg(F.count(F.lit(1)).alias("num_trips")))


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_weather_join_rewrite_equals_pair_join(spark):
    trips = v_trips(spark, SF_SMALL)
    w = weather_view(json_weather_inline(spark, SF_SMALL))
    assert _same(an.weather_trip_counts(trips, w), _pairs(trips, w))


def test_weather_join_rewrite_under_skew(spark):
    # one hour holds a third of all trips and of all observations
    trips = v_trips(spark, SF_SMALL)
    n = trips.count()
    hot = F.lit("2024-01-07 08:15:00").cast("timestamp_ntz")
    skewed = trips.withColumn("starttime", F.when(F.col("bikeid") % 3 == 0, hot).otherwise(F.col("starttime")))
    w = weather_view(json_weather_inline(spark, SF_SMALL))
    wsk = w.withColumn("observation_time",
                       F.when(F.col("clouds") % 3 == 0, hot).otherwise(F.col("observation_time")))
    fast = an.weather_trip_counts(skewed, wsk)
    assert _same(fast, _pairs(skewed, wsk))
    assert fast.agg(F.sum("num_trips")).first()[0] > n  # the hot hour fans out


def _py_boundary_minutes(a: dt.datetime, b: dt.datetime) -> int:
    fa = a.replace(second=0, microsecond=0)
    fb = b.replace(second=0, microsecond=0)
    return int((fb - fa).total_seconds() // 60)


times = st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2040, 1, 1))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(times, times), min_size=1, max_size=200))
def test_boundary_minutes_match_python(spark, pairs):
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(datediff_boundary("minute", "a", "b")).collect()]
    assert got == [_py_boundary_minutes(a, b) for a, b in pairs]
