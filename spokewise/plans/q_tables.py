"""Registered merge / version / masking queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from spokewise.operators import analytics as an
from spokewise.operators.masking import (
    SIMPLE_MASK_INT, SIMPLE_MASK_STRING, TRIPS_STREAM_MASKS, apply_masks, per_role,
)
from spokewise.operators.merge import STATION_COLS, merge_insert_only, stations_union
from spokewise.operators.semistructured import weather_view
from spokewise.operators.snapshots import first_statement_like, update_all, version_counts
from spokewise.plans.adapters import (
    V_TRIPS_SQL, V_TRIPS_STREAM_SQL, V_WEATHER_SQL, json_weather_data, trips_stream_from_trips,
    v_trips, with_ctes,
)
from spokewise.plans.registry import register
from spokewise.session import new_workdir
from spokewise.sources.loader import Catalog
from spokewise.sources.tables import VersionedTable

# fixed value: trips longer than this get a renamed start station (two names per id, T12)
RENAME_SECS = 3000

V_TRIPS_R_SQL = (f"v_trips_r AS (SELECT * REPLACE (CASE WHEN tripduration > {RENAME_SECS} "
                 "THEN start_station_name || ' (new)' ELSE start_station_name END AS start_station_name) "
                 "FROM v_trips)")


def _arm(prefix):
    return (f"SELECT {prefix}_station_id AS station_id, {prefix}_station_name AS station_name, "
            f"{prefix}_station_latitude AS station_latitude, {prefix}_station_longitude AS station_longitude, "
            f"'Station at ' || {prefix}_station_name AS station_comment FROM v_trips_r")


UNION_SQL = f"u AS ({_arm('start')} UNION {_arm('end')})"
SEED_SQL = ("seed AS (SELECT DISTINCT end_station_id AS station_id, end_station_name AS station_name, "
            "end_station_latitude AS station_latitude, end_station_longitude AS station_longitude, "
            "'Station at ' || end_station_name AS station_comment FROM v_trips_r)")
TRIPS = with_ctes(V_TRIPS_SQL)


def renamed_trips(trips):
    return trips.withColumn(
        "start_station_name",
        F.when(F.col("tripduration") > RENAME_SECS, F.concat("start_station_name", F.lit(" (new)")))
         .otherwise(F.col("start_station_name")))


@register("stations_union", ids="U1 T11 F12", oracle=with_ctes(V_TRIPS_SQL, V_TRIPS_R_SQL, UNION_SQL)
          + "SELECT * FROM u")
def q_stations_union(spark, sf):
    return stations_union(renamed_trips(v_trips(spark, sf)))


@register("merge_insert_only", ids="J3 D2 T12", oracle=with_ctes(V_TRIPS_SQL, V_TRIPS_R_SQL, UNION_SQL, SEED_SQL)
          + "SELECT * FROM seed UNION ALL SELECT * FROM u WHERE NOT EXISTS "
            "(SELECT 1 FROM seed WHERE seed.station_id = u.station_id)")
def q_merge_insert_only(spark, sf):
    root = new_workdir(spark, "merge")
    trips = renamed_trips(v_trips(spark, sf))
    st = VersionedTable(spark, f"{root}/bike_stations", "bike_stations")
    seed = trips.select(F.col("end_station_id").cast("int").alias("station_id"),
                        F.col("end_station_name").alias("station_name"),
                        F.col("end_station_latitude").alias("station_latitude"),
                        F.col("end_station_longitude").alias("station_longitude"),
                        F.concat(F.lit("Station at "), "end_station_name").alias("station_comment")).distinct()
    st.create(seed, "create table bike_stations as select ...")
    new_rows = merge_insert_only(st.read(), stations_union(trips))
    st.append(new_rows.select(*STATION_COLS), "merge into bike_stations ... when not matched then insert")
    return st.read()


# ---------------------------------------------------------------- versions

T0 = "2024-02-01 09:00:00"
T1 = "2024-02-01 09:05:00"
T2 = "2024-02-01 09:06:00"


def _trips_table(spark, sf, tag):
    root = new_workdir(spark, tag)
    t = VersionedTable(spark, f"{root}/trips", "trips")
    t.create(v_trips(spark, sf), "create table trips as select ...", now=T0)
    return root, t


@register("update_all", ids="D1", oracle=TRIPS + "SELECT 'oops' AS station, count(*) AS rides FROM v_trips")
def q_update_all(spark, sf):
    _, t = _trips_table(spark, sf, "upd")
    update_all(t, "start_station_name", "oops", now=T1)
    return an.top_stations(t.read(), 20)


@register("snapshot_log", ids="V1", oracle=TRIPS + """
SELECT CAST(0 AS BIGINT) AS version, 'create' AS op, count(*) AS row_count, count(DISTINCT start_station_name) AS stations FROM v_trips
UNION ALL SELECT 1, 'update', count(*), 1 FROM v_trips""")
def q_snapshot_log(spark, sf):
    _, t = _trips_table(spark, sf, "log")
    update_all(t, "start_station_name", "oops", now=T1)
    counts = version_counts(t, "start_station_name").select("version", "row_count", F.col("n_values").alias("stations"))
    return t.history().select("version", "op").join(counts, "version")


@register("read_before", ids="V2 P18", oracle=TRIPS + """
SELECT start_station_name AS station, count(*) AS rides FROM v_trips GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def q_read_before(spark, sf):
    _, t = _trips_table(spark, sf, "before")
    update_all(t, "start_station_name", "oops", now=T1)
    qid = first_statement_like(t, "update%")
    return an.top_stations(t.read_before(qid), 20)


@register("restore_before", ids="V3 S18", oracle=TRIPS + """
SELECT start_station_name AS station, count(*) AS rides FROM v_trips GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def q_restore_before(spark, sf):
    _, t = _trips_table(spark, sf, "restore")
    update_all(t, "start_station_name", "oops", now=T1)
    t.restore_before(first_statement_like(t, "update%"), now=T2)
    return an.top_stations(t.read(), 20)


@register("earliest_update", ids="O3 T15", oracle=TRIPS + """
SELECT 'update trips set start_station_name = ''oops''' AS query_text, CAST(1 AS BIGINT) AS version,
       count(*) AS rows_before, count(DISTINCT start_station_name) AS stations_before FROM v_trips""")
def q_earliest_update(spark, sf):
    _, t = _trips_table(spark, sf, "earliest")
    update_all(t, "start_station_name", "oops", now=T1)
    update_all(t, "usertype", "x", now=T2)
    qid = first_statement_like(t, "update%")
    e = [x for x in t.log() if x.query_id == qid][0]
    before = t.read_before(qid)
    return (before.agg(F.count(F.lit(1)).alias("rows_before"),
                       F.count_distinct("start_station_name").alias("stations_before"))
            .select(F.lit(e.query_text).alias("query_text"), F.lit(e.version).cast("bigint").alias("version"),
                    "rows_before", "stations_before"))


@register("undrop", ids="V4", oracle=with_ctes(V_WEATHER_SQL) + """
SELECT weather, count(*) AS observations FROM v_weather WHERE city_id = 5128638 GROUP BY 1""")
def q_undrop(spark, sf):
    root = new_workdir(spark, "undrop")
    t = VersionedTable(spark, f"{root}/json_weather_data", "json_weather_data")
    t.create(json_weather_data(spark, sf), now=T0)
    t.drop(now=T1)
    try:
        t.read()
        raise AssertionError("a dropped table was readable")
    except LookupError:
        pass
    t.undrop(now=T2)
    return weather_view(t.read()).groupBy("weather").agg(F.count(F.lit(1)).alias("observations"))


@register("clone_table", ids="V5", oracle=TRIPS + """
SELECT 'trips' AS table_name, start_station_name AS station, count(*) AS rides FROM v_trips GROUP BY 2
UNION ALL SELECT 'trips_dev', 'oops', count(*) FROM v_trips""")
def q_clone_table(spark, sf):
    root, t = _trips_table(spark, sf, "clone")
    dev = t.clone(f"{root}/trips_dev", "trips_dev", now=T1)
    update_all(dev, "start_station_name", "oops", now=T2)

    def counts(tab):
        return (tab.read().groupBy(F.col("start_station_name").alias("station"))
                .agg(F.count(F.lit(1)).alias("rides")).select(F.lit(tab.name).alias("table_name"), "*"))
    return counts(t).unionByName(counts(dev))


# ---------------------------------------------------------------- masking

STREAM = with_ctes(V_TRIPS_SQL, V_TRIPS_STREAM_SQL)


def _trips_stream(spark, sf):
    return trips_stream_from_trips(v_trips(spark, sf))


@register("mask_string", ids="G1 T21 F15", oracle=TRIPS + """
SELECT 'ACCOUNTADMIN' AS role, usertype, count(*) AS n FROM v_trips GROUP BY 2
UNION ALL SELECT 'SYSADMIN', '*** masked ***', count(*) FROM v_trips""")
def q_mask_string(spark, sf):
    t = v_trips(spark, sf).select("usertype")
    return (per_role(t, ["ACCOUNTADMIN", "SYSADMIN"], {"usertype": SIMPLE_MASK_STRING})
            .groupBy("role", "usertype").agg(F.count(F.lit(1)).alias("n")))


@register("mask_int", ids="G2 T21", oracle=TRIPS + """
SELECT 'ACCOUNTADMIN' AS role, bikeid, birth_year, count(*) AS n FROM v_trips GROUP BY 2, 3
UNION ALL SELECT 'SYSADMIN', -999, -999, count(*) FROM v_trips""")
def q_mask_int(spark, sf):
    t = v_trips(spark, sf).select("bikeid", "birth_year")
    return (per_role(t, ["ACCOUNTADMIN", "SYSADMIN"], {"bikeid": SIMPLE_MASK_INT, "birth_year": SIMPLE_MASK_INT})
            .groupBy("role", "bikeid", "birth_year").agg(F.count(F.lit(1)).alias("n")))


@register("masked_table", ids="G3", oracle=STREAM + """
SELECT tripduration, starttime, stoptime, start_station_id, end_station_id, -999 AS bikeid,
       '*** masked ***' AS usertype, -999 AS birth_year, -999 AS gender, program_id
FROM v_trips_stream""")
def q_masked_table(spark, sf):
    return apply_masks(_trips_stream(spark, sf), TRIPS_STREAM_MASKS, "SYSADMIN")


@register("masked_aggregate", ids="G3", oracle=STREAM + """
SELECT 'SYSADMIN' AS role, 0 AS n_click, -999.0 AS avg_birth_year, count(*) AS n FROM v_trips_stream
UNION ALL
SELECT 'ACCOUNTADMIN', count(*) FILTER (WHERE usertype = 'click'), round(avg(birth_year), 6), count(*)
FROM v_trips_stream""")
def q_masked_aggregate(spark, sf):
    m = per_role(_trips_stream(spark, sf), ["SYSADMIN", "ACCOUNTADMIN"], TRIPS_STREAM_MASKS)
    return m.groupBy("role").agg(F.count(F.when(F.col("usertype") == "click", 1)).alias("n_click"),
                                 F.round(F.avg("birth_year"), 6).alias("avg_birth_year"),
                                 F.count(F.lit(1)).alias("n"))


@register("masked_read", ids="G3 F15", oracle=STREAM + """
SELECT 'PUBLIC' AS role, '*** masked ***' AS usertype, count(*) AS n, -999.0 AS avg_birth_year, 0 AS clicks FROM v_trips_stream
UNION ALL
SELECT 'ACCOUNTADMIN', usertype, count(*), round(avg(birth_year), 6), count(*) FILTER (WHERE usertype = 'click')
FROM v_trips_stream GROUP BY 2""")
def q_masked_read(spark, sf):
    # policies bound to the table: readers get masked columns by their role, without asking for it
    cat = Catalog(spark, new_workdir(spark, "bound") + "/db")
    cat.table("trips_stream").create(_trips_stream(spark, sf))
    cat.set_masks("trips_stream", TRIPS_STREAM_MASKS)

    def seen(role):
        t = cat.read("trips_stream", role=role)
        return t.groupBy(F.lit(role or "PUBLIC").alias("role"), "usertype").agg(
            F.count(F.lit(1)).alias("n"), F.round(F.avg("birth_year"), 6).alias("avg_birth_year"),
            F.count_if(F.col("usertype") == "click").alias("clicks"))

    return seen(None).unionByName(seen("ACCOUNTADMIN"))
