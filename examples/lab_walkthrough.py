"""The reference's labs, step by step, on the adapter data.

usage: python examples/lab_walkthrough.py [sf_dir]

Bulk load with a pattern and ON_ERROR=CONTINUE, hourly and weekday
analytics, the weather view and join, a wrong update and its restore,
masking by role, then the continuous pipeline: day unloads, the pipe,
two consumers, and the overview.
"""

from __future__ import annotations

import datetime as dt
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from spokewise import schemas  # noqa: E402
from spokewise.operators import analytics as an  # noqa: E402
from spokewise.operators.masking import TRIPS_STREAM_MASKS, apply_masks  # noqa: E402
from spokewise.operators.semistructured import weather_view  # noqa: E402
from spokewise.operators.snapshots import first_statement_like, update_all  # noqa: E402
from spokewise.plans import fixtures  # noqa: E402
from spokewise.plans.adapters import json_weather_data, trips_stream_from_trips, v_trips  # noqa: E402
from spokewise.session import build_session, new_workdir  # noqa: E402
from spokewise.sources import loader  # noqa: E402
from spokewise.sources.formats import FORMAT_A  # noqa: E402
from spokewise.sources.unload import unload_json_by_day  # noqa: E402
from spokewise.streaming import consumers as cs  # noqa: E402
from spokewise.streaming import ingest as ig  # noqa: E402
from spokewise.streaming import observe as ob  # noqa: E402


def run(spark, sf_dir: str) -> dict:
    out = {}
    root = new_workdir(spark, "lab")
    trips_src = v_trips(spark, sf_dir)

    # bulk load: CSV files with JSON files mixed in, malformed rows, ON_ERROR=CONTINUE, PATTERN
    stage = f"{root}/stage"
    fixtures.write_trips_csv(trips_src, stage, header=True, corrupt=True)
    unload_json_by_day(trips_src, f"{stage}/json", "1900-01-01", "2999-12-31")
    cat = loader.Catalog(spark, f"{root}/db")
    rep = loader.copy_into(cat, "trips", stage, schemas.TRIPS, FORMAT_A, on_error="continue",
                           pattern=r".*[.]csv[.]gz", rejects_table="trips_rejects")
    out["loaded"], out["rejected"] = rep.rows_loaded, rep.rows_rejected
    trips = cat.table("trips")

    # analytics
    out["hours"] = an.trips_per_hour(trips.read()).count()
    out["weekdays"] = [tuple(r) for r in an.trips_per_weekday(trips.read()).collect()]
    w = weather_view(json_weather_data(spark, sf_dir))
    out["conditions"] = [tuple(r) for r in an.weather_trip_counts(trips.read(), w).collect()]

    # a wrong update, found in the history and undone
    update_all(trips, "start_station_name", "oops")
    qid = first_statement_like(trips, "update%")
    trips.restore_before(qid)
    out["top_after_restore"] = an.top_stations(trips.read(), 3).collect()[0]["station"]

    # masking by role
    masked = apply_masks(trips_stream_from_trips(trips.read()), TRIPS_STREAM_MASKS, "SYSADMIN")
    out["masked_usertypes"] = [r[0] for r in masked.select("usertype").distinct().collect()]

    # continuous pipeline
    landing, raw, state = f"{root}/landing", f"{root}/raw", f"{root}/state"
    unload_json_by_day(trips.read(), landing, "1900-01-01", "2999-12-31")
    ig.run_pipe_once(ig.json_source(spark, landing, max_files_per_trigger=8), raw, f"{root}/_pipe")
    c1, c2 = cs.Consumer("push_trips", state), cs.Consumer("push_stations", state)
    now = dt.datetime.now().replace(microsecond=0)
    cs.await_all(cs.start_consumer(spark, c1, raw, cs.push_trips_handler(f"{root}/bike_trips"), clock=cs.Clock(now)),
                 cs.start_consumer(spark, c2, raw, cs.push_stations_handler(spark, f"{root}/bike_stations"),
                                   clock=cs.Clock(now)))
    ov = ob.overview(spark, now=now, state_root=state, landing=landing, raw_path=raw, raw_table_name="trips_raw",
                     stream_consumer=c1,
                     bike_trips=cs.read_batches(spark, f"{root}/bike_trips", schemas.BIKE_TRIPS),
                     bike_stations=cs.read_batches(spark, f"{root}/bike_stations", schemas.BIKE_STATIONS),
                     trips=trips.read())
    out["overview"] = ov.first().asDict()
    return out


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    s = build_session()
    for k, v in run(s, sf).items():
        print(f"{k}: {v}")
    s.stop()
