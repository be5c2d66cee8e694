"""Pipe and consumers (T-1 ... T-15): batches, restarts, peek, gate, idempotent replay."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from spokewise import schemas
from spokewise.plans.adapters import v_trips
from spokewise.sources.unload import unload_json_by_day
from spokewise.streaming import consumers as cs
from spokewise.streaming import ingest as ig
from spokewise.streaming import observe as ob


def test_pipe_consumers_peek_gate(spark, workdir):
    trips = v_trips(spark, SF_SMALL)
    landing, raw, ck = f"{workdir}/landing", f"{workdir}/raw", f"{workdir}/ck"
    unload_json_by_day(trips, landing, "2024-01-01", "2024-01-10", partitions=8)
    src = lambda: ig.json_source(spark, landing, max_files_per_trigger=3)
    n1 = ig.run_pipe_once(src(), raw, ck)
    first = trips.where(F.col("starttime") < F.lit("2024-01-11").cast("timestamp_ntz")).count()
    assert n1 == first
    # restart: nothing new, nothing added
    assert ig.run_pipe_once(src(), raw, ck) == 0
    assert ig.read_raw(spark, raw).count() == first

    state = f"{workdir}/state"
    c = cs.Consumer("push_trips", state)
    bt = f"{workdir}/bike_trips"
    assert ob.peek(spark, c, raw).count() == first
    b1 = cs.run_consumer(spark, c, raw, cs.push_trips_handler(bt), clock=cs.Clock(dt.datetime(2024, 2, 1)), run=1)
    assert b1 >= 1
    assert ob.peek(spark, c, raw).count() == 0
    # gate: nothing new, no batch
    assert cs.run_consumer(spark, c, raw, cs.push_trips_handler(bt), run=2) == 0

    unload_json_by_day(trips, landing, "2024-01-11", "2024-12-31", mode="append")
    assert ob.pending_files(spark, landing, raw).count() > 0
    ig.run_pipe_once(src(), raw, ck)
    assert ob.pending_files(spark, landing, raw).count() == 0
    peeked = ob.peek(spark, c, raw).count()
    assert peeked == trips.count() - first
    cs.run_consumer(spark, c, raw, cs.push_trips_handler(bt), run=3)
    out = cs.read_batches(spark, bt, schemas.BIKE_TRIPS).drop("batch_id")
    expect = trips.select(*[f.name for f in schemas.BIKE_TRIPS.fields])
    # N micro-batches give the same table as one batch
    assert out.exceptAll(expect).count() == 0 and expect.exceptAll(out).count() == 0

    # a second consumer on the same raw table sees every row once, independently
    c2 = cs.Consumer("push_stations", state)
    bs = f"{workdir}/bike_stations"
    cs.run_consumer(spark, c2, raw, cs.push_stations_handler(spark, bs), run=1)
    st = cs.read_batches(spark, bs, schemas.BIKE_STATIONS)
    assert st.count() == st.select("station_id").distinct().count()

    hist = ob.run_history(spark, state)
    assert hist.where("state = 'SCHEDULED'").count() == 2
    assert ob.next_runs(hist, "2024-02-01 00:00:00").count() == 2


def test_replayed_batch_is_idempotent(spark, workdir):
    trips = v_trips(spark, SF_SMALL)
    raw_like = trips.select(F.to_json(F.struct(*schemas.TRIP_DOC_KEYS)).alias("j"))
    batch = raw_like.select(F.parse_json("j").alias("v"))
    bt = f"{workdir}/bike_trips"
    h = cs.push_trips_handler(bt)
    h(batch, 7)
    h(batch, 7)  # at-least-once replay of batch 7
    assert cs.read_batches(spark, bt, schemas.BIKE_TRIPS).count() == trips.count()


def test_csv_pipe_rejects(spark, workdir):
    import os
    landing = f"{workdir}/landing"
    os.makedirs(landing)
    with open(f"{landing}/a.csv", "w") as f:
        f.write("1,2018-01-01 00:00:00,2018-01-01 00:10:00,1,2,3,Member,1980,1,7\n")
        f.write("x,2018-01-01 00:00:00,2018-01-01 00:10:00,1,2,3,Member,1980,1,7\n")
        f.write("1,2018-01-01 00:00:00\n")
    from spokewise.sources.formats import CsvFormat
    src = ig.csv_source(spark, landing, schemas.TRIPS_STREAM, CsvFormat())
    ig.run_pipe_once(src, f"{workdir}/raw", f"{workdir}/ck")
    raw = spark.read.parquet(f"{workdir}/raw")
    assert raw.where("_ok = 'true'").count() == 1 and raw.where("_ok = 'false'").count() == 2


def test_purge_by_clean_source_and_candidates(spark, workdir):
    import os
    trips = v_trips(spark, SF_SMALL)
    landing, raw, ck, arch = f"{workdir}/landing", f"{workdir}/raw", f"{workdir}/ck", f"{workdir}/archive"
    unload_json_by_day(trips, landing, "2024-01-01", "2024-01-05", partitions=4)
    before = ob.pending_files(spark, landing, raw).count()
    ig.run_pipe_once(ig.json_source(spark, landing, load_time="2024-02-01 10:00:00"), raw, ck)
    cands = ob.purge_candidates(spark, raw, "trips_raw", landing, "2024-02-01 12:00:00", hours=10)
    assert cands.count() == before
    assert ob.purge_candidates(spark, raw, "trips_raw", landing, "2024-02-01 23:00:00", hours=10).count() == 0
    # removal: the source archives what it has committed (one batch behind)
    unload_json_by_day(trips, landing, "2024-01-06", "2024-01-08", mode="append")
    for _ in range(2):
        ig.run_pipe_once(ig.json_source(spark, landing, clean_source="archive", archive_dir=arch), raw, ck)
    archived = [f for _, _, fs in os.walk(arch) for f in fs if f.startswith("part-")]
    assert len(archived) >= before


def test_scheduled_trigger_starts_and_stops(spark, workdir):
    trips = v_trips(spark, SF_SMALL)
    landing = f"{workdir}/landing"
    unload_json_by_day(trips, landing, "2024-01-01", "2024-01-02")
    q = ig.start_pipe(ig.json_source(spark, landing), f"{workdir}/raw", f"{workdir}/ck")
    try:
        q.processAllAvailable()
        assert ig.read_raw(spark, f"{workdir}/raw").count() > 0
    finally:
        q.stop()


def test_bounded_consumer_batches_equal_one_batch(spark, workdir):
    trips = v_trips(spark, SF_SMALL)
    landing, raw = f"{workdir}/landing", f"{workdir}/raw"
    unload_json_by_day(trips, landing, "2024-01-01", "2024-12-31", partitions=8)
    ig.run_pipe_once(ig.json_source(spark, landing, max_files_per_trigger=4), raw, f"{workdir}/ck")
    out = {}
    for name, bound in (("small", 2), ("whole", None)):
        c = cs.Consumer(name, f"{workdir}/state")
        q = cs.start_consumer(spark, c, raw, cs.push_trips_handler(f"{workdir}/{name}"),
                              max_files_per_trigger=bound)
        (n,) = cs.await_all(q)
        out[name] = (n, cs.read_batches(spark, f"{workdir}/{name}", schemas.BIKE_TRIPS).drop("batch_id"))
    assert out["small"][0] > out["whole"][0] == 1
    a, b = out["small"][1], out["whole"][1]
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_pipe_skip_file_semantics(spark, workdir):
    import os
    landing, raw = f"{workdir}/landing", f"{workdir}/raw"
    os.makedirs(landing)
    with open(f"{landing}/good.json", "w") as f:
        f.write('{"tripduration": 60, "starttime": "2024-01-01 00:00:00", "usertype": "a"}\n')
    with open(f"{landing}/mixed.json", "w") as f:
        f.write('{"tripduration": 61, "starttime": "2024-01-01 00:01:00", "usertype": "b"}\n{bad\n')
    ig.run_pipe_once(ig.json_source(spark, landing), raw, f"{workdir}/ck")
    assert ig.read_raw(spark, raw, skip_failed_files=False).count() == 2  # continue semantics
    assert ig.read_raw(spark, raw).count() == 1                           # skip-file semantics, the default
    c = cs.Consumer("push_trips", f"{workdir}/state")
    assert ob.peek(spark, c, raw).count() == 1
    cs.await_all(cs.start_consumer(spark, c, raw, cs.push_trips_handler(f"{workdir}/bt")))
    got = cs.read_batches(spark, f"{workdir}/bt", schemas.BIKE_TRIPS).collect()
    assert [r["usertype"] for r in got] == ["a"]
    assert ob.peek(spark, c, raw).count() == 0
    assert ob.peek(spark, c, raw, skip_failed_files=False).count() == 0  # the skipped file counts as consumed


def test_skip_file_is_exact_in_bounded_batches(spark, workdir):
    """A failed file spread over several raw files: no batch of one raw file offers any of its rows."""
    import json
    import os
    landing, raw = f"{workdir}/landing", f"{workdir}/raw"
    os.makedirs(landing)
    for f in range(3):
        lines = [json.dumps({"tripduration": 100 * f + k, "usertype": "u" * 50}) + "\n" for k in range(40)]
        with open(f"{landing}/f{f}.json", "w") as out:
            out.writelines(lines + (["{broken\n"] if f == 1 else []))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        ig.run_pipe_once(ig.json_source(spark, landing), raw, f"{workdir}/ck")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    c = cs.Consumer("push_trips", f"{workdir}/state")
    n = cs.run_consumer(spark, c, raw, cs.push_trips_handler(f"{workdir}/bt"), max_files_per_trigger=1)
    assert n > 3
    got = {r.tripduration for r in cs.read_batches(spark, f"{workdir}/bt", schemas.BIKE_TRIPS).collect()}
    assert got == {100 * f + k for f in (0, 2) for k in range(40)}
    assert ob.peek(spark, c, raw).count() == 0


def test_peek_reads_open_commits_only_and_truncate_hides_commits(spark, workdir):
    import os
    landing, raw = f"{workdir}/landing", f"{workdir}/raw"
    os.makedirs(landing)
    c = cs.Consumer("push_trips", f"{workdir}/state")

    def load(name):
        with open(f"{landing}/{name}.json", "w") as f:
            f.write('{"tripduration": 1, "usertype": "%s"}\n' % name)
        ig.run_pipe_once(ig.json_source(spark, landing), raw, f"{workdir}/ck")

    def names(df):
        return sorted(r.usertype for r in df.select(F.expr("variant_get(v, '$.usertype', 'string')").alias("usertype")).collect())

    load("a")
    cs.run_consumer(spark, c, raw, cs.push_trips_handler(f"{workdir}/bt"))
    assert ob.open_commits(spark, c, raw) == [] and ob.peek(spark, c, raw).count() == 0
    load("b")
    peeked = ob.peek(spark, c, raw)
    assert names(peeked) == ["b"] and len(ob.open_commits(spark, c, raw)) == 1
    plan = peeked._jdf.queryExecution().executedPlan().toString()
    assert f"_commit#" in plan and f" = {ob.open_commits(spark, c, raw)[0]})" in plan[plan.index("PartitionFilters"):]
    assert ig.truncate_raw(spark, raw) == ig.last_commit(spark, raw)
    assert ob.peek(spark, c, raw).count() == 0 and ig.read_raw(spark, raw).count() == 0
    load("c")
    assert names(ig.read_raw(spark, raw)) == ["c"] and names(ob.peek(spark, c, raw)) == ["c"]
    cs.run_consumer(spark, c, raw, cs.push_trips_handler(f"{workdir}/bt"))
    assert sorted(r.usertype for r in cs.read_batches(spark, f"{workdir}/bt", schemas.BIKE_TRIPS).collect()) == ["a", "c"]
    assert ob.pending_files(spark, landing, raw).count() == 0 and ig.read_pipe_ledger(spark, raw).count() == 3


def test_peek_after_an_interrupted_bounded_consumer(spark, workdir):
    """A landing file spread over several raw files is consumed in part: peek returns exactly the rest."""
    import json
    import os

    import pytest
    landing, raw = f"{workdir}/landing", f"{workdir}/raw"
    os.makedirs(landing)
    for f in range(2):
        with open(f"{landing}/f{f}.json", "w") as out:
            out.writelines(json.dumps({"tripduration": 10 * f + k, "usertype": "u" * 50}) + "\n" for k in range(20))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    try:
        ig.run_pipe_once(ig.json_source(spark, landing), raw, f"{workdir}/ck")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    total = ig.read_raw(spark, raw).count()
    assert total == 40
    c, done = cs.Consumer("push_trips", f"{workdir}/state"), []

    def handler(df, batch_id):
        if batch_id == 2:
            raise RuntimeError("stopped")
        done.append(df.count())

    with pytest.raises(Exception):
        cs.await_all(cs.start_consumer(spark, c, raw, handler, max_files_per_trigger=1))
    assert 0 < sum(done) < total and ob.peek(spark, c, raw).count() == total - sum(done)


def test_row_count_beyond_the_progress_window(spark, workdir):
    import os
    landing = f"{workdir}/landing"
    os.makedirs(landing)
    for f in range(6):
        with open(f"{landing}/f{f}.json", "w") as out:
            out.write('{"a": 1}\n{"a": 2}\n')
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        src = ig.json_source(spark, landing, max_files_per_trigger=1)
        assert ig.run_pipe_once(src, f"{workdir}/raw", f"{workdir}/ck") == 12
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
