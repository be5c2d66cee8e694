"""Registered continuous-pipeline queries (T-1 ... T-16, J2, J4).

One pipeline run per (session, data folder) is shared by these queries:

1. the first half of the days is unloaded as JSON into the landing folder
   (S14) and the pipe ingests it (several micro-batches);
2. both consumers run (``push_trips``, ``push_stations``);
3. the second half is unloaded; pending files and a peek of the stream
   are recorded; the pipe ingests it; both consumers run again;
4. both consumers run a third time with nothing new: the gate.

Every step is a Spark job or an ``availableNow`` streaming query, and
all times written to logs come from a fixed clock, so results are
reproducible.
"""

from __future__ import annotations

import datetime as _dt
import threading
from dataclasses import dataclass, field

from pyspark.sql import functions as F

from spokewise import schemas
from spokewise.operators.semistructured import trip_fields
from spokewise.plans.adapters import V_TRIPS_SQL, V_TRIPS_STREAM_SQL, v_trips, with_ctes
from spokewise.plans.fixtures import BAD_RULE_SQL, csv_lines, write_lines, write_trips_json
from spokewise.plans.registry import register
from spokewise.session import new_workdir
from spokewise.sources.formats import CsvFormat
from spokewise.sources.stage import day_of_path, list_stage
from spokewise.sources.tables import path_exists
from spokewise.sources.unload import unload_json_by_day
from spokewise.streaming import consumers as cs
from spokewise.streaming import ingest as ig
from spokewise.streaming import observe as ob

# fixed values: the schedule of the reproducible pipeline run
SPLIT_DAY = "2024-01-15"
LOAD_1 = "2024-02-01 10:00:00"
LOAD_2 = "2024-02-01 11:30:00"
RUN_1 = _dt.datetime(2024, 2, 1, 11, 0, 0)
RUN_2 = _dt.datetime(2024, 2, 1, 11, 58, 0)
RUN_3 = _dt.datetime(2024, 2, 1, 11, 59, 0)
NOW = "2024-02-01 12:00:00"
FILES_PER_TRIGGER = 8
BROKEN_DAY = "2024-01-20"

TRIPS = with_ctes(V_TRIPS_SQL)
BIKE_TRIP_COLS = ", ".join(f.name for f in schemas.BIKE_TRIPS.fields)
DAY = "strftime(CAST(starttime AS DATE), '%Y-%m-%d')"
LATE = f"CAST(starttime AS DATE) > DATE '{SPLIT_DAY}'"


@dataclass
class Flow:
    root: str
    landing: str
    raw: str
    state: str
    bike_trips: str
    bike_stations: str
    trips_consumer: cs.Consumer
    stations_consumer: cs.Consumer
    saved: str
    gate: dict = field(default_factory=dict)


_FLOWS: dict[tuple, Flow] = {}
_FLOW_LOCK = threading.Lock()


def run_flow(spark, sf) -> Flow:
    """The shared pipeline run for this session and data folder (built once, under a lock)."""
    with _FLOW_LOCK:
        key = (id(spark), spark.sparkContext.applicationId, sf)
        f = _FLOWS.get(key)
        if f is not None and path_exists(spark, f.saved + "/gate"):
            return f
        f = _build_flow(spark, sf)
        _FLOWS[key] = f
        return f


def _build_flow(spark, sf) -> Flow:
    root = new_workdir(spark, "flow")
    f = Flow(root, f"{root}/landing", f"{root}/raw", f"{root}/state", f"{root}/bike_trips",
             f"{root}/bike_stations", cs.Consumer("push_trips", f"{root}/state"),
             cs.Consumer("push_stations", f"{root}/state"), f"{root}/saved")
    trips = v_trips(spark, sf)
    pipe_ckpt = f"{root}/_pipe_checkpoint"
    next_day = (_dt.date.fromisoformat(SPLIT_DAY) + _dt.timedelta(days=1)).isoformat()

    def ingest(load_time):
        src = ig.json_source(spark, f.landing, max_files_per_trigger=FILES_PER_TRIGGER, load_time=load_time)
        ig.run_pipe_once(src, f.raw, pipe_ckpt)

    def consume(run, at):
        # the two tasks are independent streams on the same table: run them side by side
        q1 = cs.start_consumer(spark, f.trips_consumer, f.raw, cs.push_trips_handler(f.bike_trips),
                               clock=cs.Clock(at), run=run)
        q2 = cs.start_consumer(spark, f.stations_consumer, f.raw,
                               cs.push_stations_handler(spark, f.bike_stations), clock=cs.Clock(at), run=run)
        n1, n2 = cs.await_all(q1, q2)
        return {"push_trips": n1, "push_stations": n2}

    unload_json_by_day(trips, f.landing, None, SPLIT_DAY, one_file_per_day=True)
    ingest(LOAD_1)
    consume(1, RUN_1)
    unload_json_by_day(trips, f.landing, next_day, None, mode="append", one_file_per_day=True)
    ob.pending_files(spark, f.landing, f.raw).select("path", "name").write.parquet(f"{f.saved}/pending")
    ingest(LOAD_2)
    trip_fields(ob.peek(spark, f.trips_consumer, f.raw)).write.parquet(f"{f.saved}/peek")
    consume(2, RUN_2)
    f.gate = consume(3, RUN_3)
    spark.createDataFrame([(k, v) for k, v in f.gate.items()], "name string, gate_batches int") \
        .write.parquet(f"{f.saved}/gate")
    return f


def _bike_trips(spark, f):
    return cs.read_batches(spark, f.bike_trips, schemas.BIKE_TRIPS).select(
        *[x.name for x in schemas.BIKE_TRIPS.fields])


def _bike_stations(spark, f):
    return cs.read_batches(spark, f.bike_stations, schemas.BIKE_STATIONS).select(
        *[x.name for x in schemas.BIKE_STATIONS.fields])


@register("stream_ingest_json", ids="T-1 S8 T-10", oracle=TRIPS + f"SELECT {BIKE_TRIP_COLS} FROM v_trips")
def q_stream_ingest_json(spark, sf):
    f = run_flow(spark, sf)
    return trip_fields(ig.read_raw(spark, f.raw))


@register("stream_ingest_csv", ids="T-2 S2", oracle=with_ctes(V_TRIPS_SQL, V_TRIPS_STREAM_SQL)
          + "SELECT * FROM v_trips_stream")
def q_stream_ingest_csv(spark, sf):
    root = new_workdir(spark, "csvpipe")
    landing = f"{root}/landing"
    from spokewise.plans.adapters import trips_stream_from_trips
    write_lines(csv_lines(trips_stream_from_trips(v_trips(spark, sf)), quote_strings=False), landing)
    fmt = CsvFormat()  # plain type=csv: no header, no enclosing quotes, strict column count
    src = ig.csv_source(spark, landing, schemas.TRIPS_STREAM, fmt, max_files_per_trigger=FILES_PER_TRIGGER)
    ig.run_pipe_once(src, f"{root}/raw", f"{root}/_checkpoint")
    out = spark.read.parquet(f"{root}/raw").where(F.col("_ok").cast("string") == "true")
    return out.select(*[x.name for x in schemas.TRIPS_STREAM.fields])


def _bad_days(d: str) -> str:
    return f"{d} IN (SELECT DISTINCT {DAY} FROM v_trips WHERE {BAD_RULE_SQL})"


@register("pipe_skip_file", ids="T-1 T18 T-3", oracle=TRIPS + f"""
SELECT {DAY} AS day, count(*) AS row_parsed, count(*) FILTER (WHERE {BAD_RULE_SQL}) AS errors,
       count(*) FILTER (WHERE NOT {_bad_days(DAY)}) AS raw_rows,
       count(*) FILTER (WHERE NOT {_bad_days(DAY)}) AS consumed
FROM v_trips GROUP BY 1""")
def q_pipe_skip_file(spark, sf):
    """One file a day, bad-rule documents cut short: a pipe offers no row of a file with an error, neither to
    readers nor to a consumer whose batches are bounded. Per day: rows and errors in the ledger, rows offered."""
    root = new_workdir(spark, "skippipe")
    landing, raw = f"{root}/landing", f"{root}/raw"
    write_trips_json(v_trips(spark, sf).repartition(F.to_date("starttime")), landing, malformed=True)
    src = ig.json_source(spark, landing, max_files_per_trigger=FILES_PER_TRIGGER, load_time=LOAD_1)
    ig.run_pipe_once(src, raw, f"{root}/_checkpoint")
    consumer = cs.Consumer("push_trips", f"{root}/state")
    cs.run_consumer(spark, consumer, raw, cs.push_trips_handler(f"{root}/bike_trips"), max_files_per_trigger=3)

    def per_day(df, day, name):
        return df.groupBy(F.date_format(day, "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias(name))

    ledger = ig.read_pipe_ledger(spark, raw).groupBy(F.date_format(day_of_path("_file"), "yyyy-MM-dd").alias("day")).agg(
        F.sum("row_parsed").alias("row_parsed"), F.sum("error_count").alias("errors"))
    seen = per_day(ig.read_raw(spark, raw), day_of_path("_file"), "raw_rows")
    taken = per_day(cs.read_batches(spark, f"{root}/bike_trips", schemas.BIKE_TRIPS), "starttime", "consumed")
    return ledger.join(seen, "day", "left").join(taken, "day", "left").fillna(0, ["raw_rows", "consumed"])


@register("raw_truncate", ids="T-1 S19 T17", oracle=TRIPS + f"""
SELECT {DAY} AS day, count(*) AS ledger_rows, count(*) FILTER (WHERE {LATE}) AS raw_rows,
       count(*) FILTER (WHERE {LATE}) AS consumed
FROM v_trips GROUP BY 1""")
def q_raw_truncate(spark, sf):
    """The raw table is truncated between two loads: rows not consumed by then are gone, loaded files are not
    loaded again, the load history stays. Per day: rows in the ledger, in the raw table, consumed."""
    root = new_workdir(spark, "rawtrunc")
    landing, raw = f"{root}/landing", f"{root}/raw"
    trips = v_trips(spark, sf)
    next_day = (_dt.date.fromisoformat(SPLIT_DAY) + _dt.timedelta(days=1)).isoformat()
    consumer = cs.Consumer("push_trips", f"{root}/state")

    def ingest(load_time):
        ig.run_pipe_once(ig.json_source(spark, landing, load_time=load_time), raw, f"{root}/_checkpoint")

    unload_json_by_day(trips, landing, None, SPLIT_DAY)
    ingest(LOAD_1)
    ig.truncate_raw(spark, raw)
    unload_json_by_day(trips, landing, next_day, None, mode="append")
    ingest(LOAD_2)
    cs.run_consumer(spark, consumer, raw, cs.push_trips_handler(f"{root}/bike_trips"))
    day = F.date_format(day_of_path("_file"), "yyyy-MM-dd").alias("day")
    ledger = ig.read_pipe_ledger(spark, raw).groupBy(day).agg(F.sum("row_parsed").alias("ledger_rows"))
    seen = ig.read_raw(spark, raw).groupBy(day).agg(F.count(F.lit(1)).alias("raw_rows"))
    taken = (cs.read_batches(spark, f"{root}/bike_trips", schemas.BIKE_TRIPS)
             .groupBy(F.date_format("starttime", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("consumed")))
    return ledger.join(seen, "day", "left").join(taken, "day", "left").fillna(0, ["raw_rows", "consumed"])


@register("change_stream", ids="T-3", oracle=TRIPS + f"""
SELECT CASE WHEN {LATE} THEN 2 ELSE 1 END AS run, count(*) AS rows_in FROM v_trips GROUP BY 1""")
def q_change_stream(spark, sf):
    f = run_flow(spark, sf)
    h = ob.run_history(spark, f.state).where((F.col("name") == "push_trips") & (F.col("state") == "SUCCEEDED"))
    return h.groupBy(F.col("run").cast("int").alias("run")).agg(F.sum("rows_in").alias("rows_in"))


@register("change_stream_two_consumers", ids="T-4", oracle=TRIPS + """
SELECT 'push_trips' AS name, count(*) AS rows_in FROM v_trips
UNION ALL SELECT 'push_stations', count(*) FROM v_trips""")
def q_change_stream_two_consumers(spark, sf):
    f = run_flow(spark, sf)
    h = ob.run_history(spark, f.state).where(F.col("state") == "SUCCEEDED")
    return h.groupBy("name").agg(F.sum("rows_in").alias("rows_in"))


@register("stream_peek", ids="T-5", oracle=TRIPS + f"SELECT {BIKE_TRIP_COLS} FROM v_trips WHERE {LATE}")
def q_stream_peek(spark, sf):
    f = run_flow(spark, sf)
    return spark.read.schema(schemas.BIKE_TRIPS).parquet(f"{f.saved}/peek")


@register("stream_gate", ids="T-6", oracle=TRIPS + """
SELECT 'push_trips' AS name, 0 AS gate_batches, count(*) AS rows_in FROM v_trips
UNION ALL SELECT 'push_stations', 0, count(*) FROM v_trips""")
def q_stream_gate(spark, sf):
    f = run_flow(spark, sf)
    gate = spark.read.parquet(f"{f.saved}/gate")
    totals = (ob.run_history(spark, f.state).where(F.col("state") == "SUCCEEDED")
              .groupBy("name").agg(F.sum("rows_in").alias("rows_in")))
    return gate.join(totals, "name").select("name", "gate_batches", "rows_in")


@register("push_trips", ids="T-7", oracle=TRIPS + f"SELECT {BIKE_TRIP_COLS} FROM v_trips")
def q_push_trips(spark, sf):
    return _bike_trips(spark, run_flow(spark, sf))


def _station_arm(p):
    return (f"SELECT {p}_station_id AS station_id, {p}_station_name AS station_name, "
            f"{p}_station_latitude AS station_latitude, {p}_station_longitude AS station_longitude, "
            f"'Station at ' || {p}_station_name AS station_comment FROM v_trips")


@register("push_stations", ids="T-8 U1 J3", oracle=TRIPS + f"{_station_arm('start')} UNION {_station_arm('end')}")
def q_push_stations(spark, sf):
    return _bike_stations(spark, run_flow(spark, sf))


@register("pending_files", ids="T-12", oracle=TRIPS + f"SELECT DISTINCT {DAY} AS day FROM v_trips WHERE {LATE}")
def q_pending_files(spark, sf):
    f = run_flow(spark, sf)
    p = spark.read.parquet(f"{f.saved}/pending")
    return p.select(F.date_format(day_of_path("name"), "yyyy-MM-dd").alias("day")).distinct()


@register("load_history_window", ids="T-13 S12", oracle=TRIPS + f"""
SELECT {DAY} AS day, 'trips_raw' AS table_name, count(*) AS row_count, 0 AS error_count,
       TIMESTAMP '{LOAD_2}' AS last_load_time
FROM v_trips WHERE {LATE} GROUP BY 1""")
def q_load_history_window(spark, sf):
    f = run_flow(spark, sf)
    h = ob.load_history(spark, f.raw, "trips_raw", NOW, hours=1)
    return (h.groupBy(F.date_format(day_of_path("file_path"), "yyyy-MM-dd").alias("day"), "table_name")
            .agg(F.sum("row_count").alias("row_count"), F.sum("error_count").cast("int").alias("error_count"),
                 F.max("last_load_time").alias("last_load_time")))


@register("run_history_recent", ids="T-14 P12 T13", oracle=TRIPS + f"""
SELECT 'push_trips' AS name, 2 AS run, 'SUCCEEDED' AS state, count(*) AS rows_in FROM v_trips WHERE {LATE}
UNION ALL SELECT 'push_stations', 2, 'SUCCEEDED', count(*) FROM v_trips WHERE {LATE}""")
def q_run_history_recent(spark, sf):
    f = run_flow(spark, sf)
    r = ob.recent_runs(ob.run_history(spark, f.state), NOW, minutes=5)
    return r.groupBy("name", F.col("run").cast("int").alias("run"), "state").agg(F.sum("rows_in").alias("rows_in"))


@register("next_run", ids="T-15 F5", oracle=TRIPS + """
SELECT 'push_trips' AS name, CAST(-59 AS BIGINT) AS next_run, TIMESTAMP '2024-02-01 11:59:01' AS scheduled_time,
       'SCHEDULED' AS state, count(*) AS rows_so_far FROM v_trips
UNION ALL SELECT 'push_stations', -59, TIMESTAMP '2024-02-01 11:59:01', 'SCHEDULED', count(*) FROM v_trips""")
def q_next_run(spark, sf):
    f = run_flow(spark, sf)
    h = ob.run_history(spark, f.state)
    totals = (h.where(F.col("state") == "SUCCEEDED").groupBy("name")
              .agg(F.sum("rows_in").alias("rows_so_far")))
    return ob.next_runs(h, NOW).join(totals, "name")


@register("purge_candidates", ids="J2 T-11", oracle=TRIPS + f"""
SELECT {DAY} AS day, count(*) AS row_count FROM v_trips GROUP BY 1""")
def q_purge_candidates(spark, sf):
    f = run_flow(spark, sf)
    c = ob.purge_candidates(spark, f.raw, "trips_raw", f.landing, NOW, hours=10)
    return (c.groupBy(F.date_format(day_of_path("filename"), "yyyy-MM-dd").alias("day"))
            .agg(F.sum("row_count").alias("row_count")))


@register("purge_after_push", ids="T-9 T-11", oracle=TRIPS + f"""
SELECT {DAY} AS day, count(*) AS row_count,
       CAST({LATE} AND CAST(starttime AS DATE) <> DATE '{BROKEN_DAY}' AS INT) AS purged
FROM v_trips GROUP BY ALL""")
def q_purge_after_push(spark, sf):
    """Two loads ten hours apart; after push_trips ran, the files of the recent, clean load are removed.
    A file with a malformed line stays, on a day whose other files go. Days, their rows, and whether all their
    files went."""
    root = new_workdir(spark, "purge")
    landing, raw, state = f"{root}/landing", f"{root}/raw", f"{root}/state"
    trips = v_trips(spark, sf)
    next_day = (_dt.date.fromisoformat(SPLIT_DAY) + _dt.timedelta(days=1)).isoformat()

    def ingest(load_time):
        ig.run_pipe_once(ig.json_source(spark, landing, load_time=load_time), raw, f"{root}/_checkpoint")

    unload_json_by_day(trips, landing, None, SPLIT_DAY)
    ingest("2024-02-01 01:00:00")
    unload_json_by_day(trips, landing, next_day, None, mode="append")
    spark.range(1).select(F.lit("{broken").alias("value")).write.mode("append").text(f"{landing}/day={BROKEN_DAY}")
    ingest(LOAD_2)
    consumer = cs.Consumer("push_trips", state)
    ran = cs.run_consumer(spark, consumer, raw, cs.push_trips_handler(f"{root}/bike_trips"), clock=cs.Clock(RUN_2))
    ob.purge_after(ran, spark, raw, "trips_raw", landing, NOW, hours=10)
    left = list_stage(spark, landing).select(F.date_format(day_of_path("name"), "yyyy-MM-dd").alias("day")).distinct()
    bike = cs.read_batches(spark, f"{root}/bike_trips", schemas.BIKE_TRIPS)
    rows = bike.groupBy(F.date_format("starttime", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("row_count"))
    return rows.join(left.withColumn("here", F.lit(1)), "day", "left").select(
        "day", "row_count", F.when(F.col("here").isNull(), 1).otherwise(0).alias("purged"))


@register("ingest_overview", ids="J4 T-16 A6 A7 A8", oracle=TRIPS + f"""
SELECT CAST(-59 AS BIGINT) AS time_to_next_pulse, count(DISTINCT {DAY}) AS files_in_bucket,
       CAST(0 AS BIGINT) AS pending_file_count, count(DISTINCT {DAY}) FILTER (WHERE {LATE}) AS files_processed,
       count(*) AS trips_raw, CAST(0 AS BIGINT) AS recs_in_stream, count(*) AS bike_trips,
       (SELECT count(*) FROM ({_station_arm('start')} UNION {_station_arm('end')})) AS bike_stations,
       max(starttime) AS max_date
FROM v_trips""")
def q_ingest_overview(spark, sf):
    f = run_flow(spark, sf)
    return ob.overview(spark, now=NOW, state_root=f.state, landing=f.landing, raw_path=f.raw,
                       raw_table_name="trips_raw", stream_consumer=f.trips_consumer,
                       bike_trips=_bike_trips(spark, f), bike_stations=_bike_stations(spark, f),
                       trips=v_trips(spark, sf))
