"""Unload round trip, station merge, table versions and masking."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from spokewise import schemas
from spokewise.operators.masking import SIMPLE_MASK_INT, SIMPLE_MASK_STRING, TRIPS_STREAM_MASKS, apply_masks
from spokewise.operators.merge import merge_insert_only, stations_union
from spokewise.operators.snapshots import first_statement_like, update_all, version_counts
from spokewise.plans.adapters import trips_stream_from_trips, v_trips
from spokewise.sources.tables import VersionedTable
from spokewise.sources.unload import distinct_days, unload_json_by_day


def _two_arms(trips):
    """U1 with one arm per station side."""
    from functools import reduce
    cols = ("station_id", "station_name", "station_latitude", "station_longitude")
    arms = [trips.select(*[F.col(f"{p}_{c}").alias(c) for c in cols],
                         F.concat(F.lit("Station at "), F.col(f"{p}_station_name")).alias("station_comment"))
            for p in ("start", "end")]
    return reduce(lambda a, b: a.unionByName(b), arms).distinct()


def test_unload_round_trip_and_sorted_files(spark, workdir):
    trips = v_trips(spark, SF_SMALL)
    out = f"{workdir}/unload"
    unload_json_by_day(trips, out, "2024-01-01", "2024-01-31", partitions=16)
    back = spark.read.schema(trips.select(*schemas.TRIP_DOC_KEYS).schema).option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").json(out)
    assert back.select(*schemas.TRIP_DOC_KEYS).exceptAll(trips.select(*schemas.TRIP_DOC_KEYS)).count() == 0
    assert back.count() == trips.count()
    # part files of a day, read in name order, are sorted by start time
    day = sorted(d for d in os.listdir(out) if d.startswith("day="))[0]
    files = sorted(f for f in os.listdir(f"{out}/{day}") if f.startswith("part-"))
    import gzip
    import json
    times = []
    for f in files:
        with gzip.open(f"{out}/{day}/{f}", "rt") as fh:
            times += [json.loads(line)["starttime"] for line in fh]
    assert times == sorted(times) and len(times) > 0
    # NULL-valued keys are absent from the documents
    assert all("membership_type" not in line for line in times)


def test_distinct_days_range(spark):
    d = [r[0] for r in distinct_days(v_trips(spark, SF_SMALL), "2024-01-03", "2024-01-05").collect()]
    assert d == ["2024-01-03", "2024-01-04", "2024-01-05"]


def test_union_one_scan_equals_two_arms(spark):
    t = v_trips(spark, SF_SMALL)
    a, b = stations_union(t), _two_arms(t)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_merge_duplicates_and_null_keys(spark):
    tgt = spark.createDataFrame([(1, "A", 0.0, 0.0, "Station at A")], schemas.BIKE_STATIONS)
    src = spark.createDataFrame([(1, "A2", 0.0, 0.0, "x"), (2, "B", 0.0, 0.0, "x"), (2, "B (new)", 0.0, 0.0, "x"),
                                 (None, "N", 0.0, 0.0, "x")], schemas.BIKE_STATIONS)
    got = sorted((r[0] if r[0] is not None else -1, r[1]) for r in merge_insert_only(tgt, src).collect())
    assert got == [(-1, "N"), (2, "B"), (2, "B (new)")]
    # a NULL key in the target never matches either: inserted again next batch
    tgt2 = tgt.unionByName(merge_insert_only(tgt, src))
    assert merge_insert_only(tgt2, src).where(F.col("station_id").isNull()).count() == 1


def test_versions_update_restore_clone_undrop(spark, workdir):
    t = VersionedTable(spark, f"{workdir}/trips", "trips")
    trips = v_trips(spark, SF_SMALL)
    t.create(trips, now="2024-02-01 09:00:00")
    n = trips.count()
    update_all(t, "start_station_name", "oops", now="2024-02-01 09:05:00")
    assert [r[0] for r in t.read().select("start_station_name").distinct().collect()] == ["oops"]
    qid = first_statement_like(t, "update%")
    before = t.read_before(qid)
    assert before.exceptAll(trips).count() == 0 and before.count() == n
    dev = t.clone(f"{workdir}/trips_dev", "trips_dev")
    t.restore_before(qid, now="2024-02-01 09:06:00")
    assert t.read().exceptAll(trips).count() == 0
    # the clone is independent of the restore
    assert dev.read().select("start_station_name").distinct().count() == 1
    t.drop()
    try:
        t.read()
        raise AssertionError("dropped table readable")
    except LookupError:
        pass
    t.undrop()
    assert t.read().count() == n
    ops = [r["op"] for r in t.history().orderBy("version").collect()]
    assert ops == ["create", "update", "restore", "drop", "undrop"]


def test_earliest_of_several_updates(spark, workdir):
    t = VersionedTable(spark, f"{workdir}/t", "t")
    t.create(spark.createDataFrame([(1, "a")], schemas.TESTTABLE), now="2024-01-01 00:00:00")
    update_all(t, "col2", "b", now="2024-01-01 00:00:02")
    update_all(t, "col2", "c", now="2024-01-01 00:00:01")
    qid = first_statement_like(t, "update%")
    assert t.read_before(qid).first()["col2"] == "b"  # the earliest update is the second operation


def test_masks(spark):
    df = spark.createDataFrame([(1, None, "click"), (2, 1990, None)], "bikeid int, birth_year int, usertype string")
    pol = {"bikeid": SIMPLE_MASK_INT, "birth_year": SIMPLE_MASK_INT, "usertype": SIMPLE_MASK_STRING}
    dev = apply_masks(df, pol, "SYSADMIN")
    assert {tuple(r) for r in dev.collect()} == {(-999, -999, "*** masked ***")}
    assert dev.where(F.col("usertype") == "click").count() == 0  # filters see masked values
    admin = apply_masks(df, pol, "accountadmin")
    assert sorted(tuple(r) for r in admin.collect()) == sorted(tuple(r) for r in df.collect())


def test_masking_commutes_with_projection(spark):
    t = trips_stream_from_trips(v_trips(spark, SF_SMALL))
    a = apply_masks(t, TRIPS_STREAM_MASKS, "SYSADMIN").select("bikeid", "usertype")
    b = apply_masks(t.select("bikeid", "usertype"), TRIPS_STREAM_MASKS, "SYSADMIN")
    assert a.exceptAll(b).count() == 0


def test_compact_keeps_rows_and_history(spark, workdir):
    t = VersionedTable(spark, f"{workdir}/t", "t")
    t.create(spark.range(0, 10).toDF("id"))
    for i in range(1, 4):
        t.append(spark.range(i * 10, i * 10 + 10).toDF("id"))
    before = t.current().version
    assert len(t.current().segments) == 4
    t.compact(files=1)
    assert len(t.current().segments) == 1 and len(t.read().inputFiles()) == 1
    assert sorted(r[0] for r in t.read().collect()) == list(range(40))
    assert t.read(before).count() == 40 and t.read(0).count() == 10


def test_unload_bounds_file_size(spark, workdir):
    import os
    trips = v_trips(spark, SF_SMALL)
    out = f"{workdir}/unload"
    unload_json_by_day(trips, out, "2024-01-01", "2024-01-31", partitions=2, max_records_per_file=10)
    day = sorted(d for d in os.listdir(out) if d.startswith("day="))[0]
    import gzip
    counts = [sum(1 for _ in gzip.open(f"{out}/{day}/{f}", "rt")) for f in os.listdir(f"{out}/{day}")
              if f.startswith("part-")]
    assert counts and max(counts) <= 10


def test_many_versions_in_one_scan_and_entries_that_do_not_grow(spark, workdir):
    t = VersionedTable(spark, f"{workdir}/many")
    t.create(spark.createDataFrame([(1, "a"), (2, None)], "id int, name string"))
    for k in range(8):
        t.append(spark.createDataFrame([(10 + k, f"n{k % 3}")], "id int, name string"))
    update = update_all(t, "name", "x")
    t.truncate()
    t.restore_before(update.query_id)
    t.drop()
    t.undrop()
    t.append(spark.createDataFrame([(99, None)], "id int, name string"))
    again = VersionedTable(spark, t.root)  # a handle that reads every entry from its file
    assert [(e.version, e.segments, e.loaded) for e in again.log()] == [(e.version, e.segments, e.loaded) for e in t.log()]
    got = {r.version: (r.row_count, r.n_values) for r in version_counts(again, "name").collect()}
    want = {}
    for e in t.log():
        df = t.read(e.version)
        want[e.version] = (0, 0) if e.dropped else df.agg(F.count(F.lit(1)), F.count_distinct("name")).first()
    assert got == {v: tuple(x) for v, x in want.items()}
    plan = version_counts(again, "name")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    sizes = [os.path.getsize(f"{t.log_path}/{n}") for n in sorted(os.listdir(t.log_path)) if n.endswith(".json")]
    assert max(sizes[1:9]) - min(sizes[1:9]) < 100
