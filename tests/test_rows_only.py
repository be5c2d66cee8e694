"""Brute-force checks for the keys without a SQL oracle (file counts, any-rows sample)."""

import gzip
import json
import os

from conftest import SF_SMALL


def _files(root, suffixes):
    out = []
    for d, _, fs in os.walk(root):
        for f in fs:
            if f.startswith("part-") and f.endswith(suffixes):
                out.append(os.path.join(d, f))
    return out


def _lines(path):
    opener = gzip.open if path.endswith(".gz") else open
    with opener(path, "rt") as fh:
        return [ln for ln in fh.read().splitlines() if ln]


def test_sample_limit_rows_come_from_trips(spark):
    import __spark_entry__ as e
    from spokewise.plans.adapters import v_trips
    s = e.queries()["sample_limit"](spark, SF_SMALL)
    assert s.count() == 20
    assert s.exceptAll(v_trips(spark, SF_SMALL)).count() == 0


def test_count_distinct_files_against_a_file_walk(spark, workdir):
    from pyspark.sql import functions as F

    from spokewise import schemas
    from spokewise.plans import fixtures
    from spokewise.plans.adapters import v_trips
    from spokewise.sources.formats import FORMAT_B
    from spokewise.sources.stage import with_provenance
    stage = f"{workdir}/stage"
    trips = v_trips(spark, SF_SMALL)
    fixtures.write_trips_csv(trips.repartition(3), stage)  # several files per day
    rows = with_provenance(spark.read.options(**FORMAT_B.reader_options()).schema(schemas.TRIPS).csv(stage))
    got = rows.agg(F.count_distinct("_file").alias("f"), F.count(F.lit(1)).alias("n")).first()
    files = [p for p in _files(stage, (".csv.gz",)) if _lines(p)]
    assert got["f"] == len(files) > 30
    assert got["n"] == sum(len(_lines(p)) for p in files) == trips.count()


def test_ingest_overview_against_brute_force(spark):
    import __spark_entry__ as e
    from spokewise.plans import q_streaming as qs
    from spokewise.plans.adapters import v_trips
    ov = e.queries()["ingest_overview"](spark, SF_SMALL).first()
    flow = qs.run_flow(spark, SF_SMALL)
    landing = _files(flow.landing, (".json.gz", ".json"))
    docs = [json.loads(ln) for p in landing for ln in _lines(p)]
    late = [p for p in landing if os.path.basename(os.path.dirname(p)) > f"day={qs.SPLIT_DAY}"]
    n = v_trips(spark, SF_SMALL).count()
    assert ov["files_in_bucket"] == len(landing)
    assert ov["pending_file_count"] == 0
    assert ov["files_processed"] == len(late)  # loaded within the hour before NOW: the second load
    assert ov["trips_raw"] == len(docs) == n
    assert ov["recs_in_stream"] == 0
    assert ov["bike_trips"] == n
    assert ov["bike_stations"] == len({(d["start_station_id"], d["start_station_name"]) for d in docs}
                                      | {(d["end_station_id"], d["end_station_name"]) for d in docs})
    assert ov["time_to_next_pulse"] == -59
    assert str(ov["max_date"]) == max(d["starttime"] for d in docs)
