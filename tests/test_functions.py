"""One test per dialect trap and the scalar helpers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from spokewise.functions import (
    asc_nulls_largest, cast_round, dateadd, datediff_boundary, desc_nulls_largest, haversine,
    month_range, object_json, seconds_until, trunc_ntz,
)
from spokewise.functions.timefn import normalize_unit


def ts(s):
    return F.lit(s).cast("timestamp_ntz")


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_t1_boundary_minutes(spark):
    assert one(spark, datediff_boundary("minute", ts("2024-01-01 00:00:59"), ts("2024-01-01 00:01:01"))) == 1
    assert one(spark, datediff_boundary("minute", ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:59"))) == 0
    assert one(spark, datediff_boundary("hour", ts("2024-01-01 00:59:00"), ts("2024-01-01 01:00:00"))) == 1
    assert one(spark, datediff_boundary("day", ts("2024-01-01 23:59:59"), ts("2024-01-02 00:00:00"))) == 1
    assert one(spark, datediff_boundary("month", ts("2024-01-31 00:00:00"), ts("2024-02-01 00:00:00"))) == 1
    assert one(spark, datediff_boundary("minute", ts("2024-01-01 00:01:01"), ts("2024-01-01 00:00:59"))) == -1


def test_t1_seconds_until(spark):
    assert one(spark, seconds_until(ts("2024-01-01 00:00:00.9"), ts("2024-01-01 00:00:01.1"))) == 1


def test_t2_cast_rounds(spark):
    vals = spark.createDataFrame([(2.5,), (2.7,), (2.4,), (-2.5,), (None,)], "x double")
    got = [r[0] for r in vals.select(cast_round("x")).collect()]
    assert got == [3, 3, 2, -3, None]


def test_t3_dayname_three_letters(spark):
    assert one(spark, F.dayname(ts("2024-01-01 10:00:00"))) == "Mon"


def test_t4_nulls_largest(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "x int")
    assert [r[0] for r in df.orderBy(asc_nulls_largest("x")).collect()] == [1, 2, None]
    assert [r[0] for r in df.orderBy(desc_nulls_largest("x")).collect()] == [None, 2, 1]


def test_t6_t7_object_json(spark):
    df = spark.createDataFrame([(1, None, dt.datetime(2018, 1, 1, 0, 0, 0, 500))],
                               "a int, b string, t timestamp_ntz")
    j = df.select(object_json("a", "b", "t")).first()[0]
    assert j == '{"a":1,"t":"2018-01-01 00:00:00.000500"}'


def test_t8_trunc_stays_ntz(spark):
    df = spark.range(1).select(trunc_ntz("hour", ts("2024-03-10 02:30:00")).alias("h"))
    assert df.schema["h"].dataType.simpleString() == "timestamp_ntz"
    assert df.first()["h"] == dt.datetime(2024, 3, 10, 2, 0)


def test_trunc_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        # 02:30 does not exist in New York on this day; the wall clock must still floor to 02:00
        assert one(spark, trunc_ntz("hour", ts("2024-03-10 02:30:00"))) == dt.datetime(2024, 3, 10, 2, 0)
        assert one(spark, trunc_ntz("month", ts("2024-03-10 02:30:00"))) == dt.datetime(2024, 3, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("unit", ["hour", "hours", "'hour'", '"HOUR"'])
def test_dateadd_units(spark, unit):
    assert one(spark, dateadd(unit, -1, ts("2024-01-01 00:30:00"))) == dt.datetime(2023, 12, 31, 23, 30)


def test_unknown_unit():
    with pytest.raises(ValueError):
        normalize_unit("fortnight")


def test_month_range(spark):
    df = spark.createDataFrame([(dt.datetime(2018, 1, 31, 23, 59),), (dt.datetime(2018, 2, 1),),
                                (dt.datetime(2017, 12, 31, 23, 59, 59),)], "t timestamp_ntz")
    assert df.where(month_range("t", "2018-01-01")).count() == 1
    assert df.where(month_range("t", "2018-01-15")).count() == 0


def test_haversine_known_distance(spark):
    # one degree of latitude is about 111.19 km on a 6371 km sphere
    d = one(spark, haversine(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0)))
    assert abs(d - 111.19492664455873) < 1e-9
    assert one(spark, haversine(F.lit(40.7), F.lit(-74.0), F.lit(40.7), F.lit(-74.0))) == 0.0


def test_concat_null_propagates(spark):
    assert one(spark, F.concat(F.lit("Station at "), F.lit(None).cast("string"))) is None


def test_workdir_under_file_uri_checkpoint_dir(spark, monkeypatch):
    import os

    from spokewise import session
    monkeypatch.setattr(session, "shared_dir", lambda s: "file:///tmp/spokewise-uri-test")
    p = session.new_workdir(spark, "uri")
    assert p.startswith("/tmp/spokewise-uri-test/spokewise/uri-") and os.path.isdir(p)
    monkeypatch.setattr(session, "shared_dir", lambda s: "hdfs://nn:8020/ckpt")
    assert session.new_workdir(spark, "h").startswith("hdfs://nn:8020/ckpt/spokewise/h-")
