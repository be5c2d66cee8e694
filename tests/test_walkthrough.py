"""The end-to-end lab walkthrough runs and its numbers agree with each other."""

import os
import sys

from conftest import SF_SMALL


def test_walkthrough(spark):
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "examples"))
    import lab_walkthrough
    from spokewise.plans.adapters import v_trips
    out = lab_walkthrough.run(spark, SF_SMALL)
    n = v_trips(spark, SF_SMALL).count()
    assert out["loaded"] + out["rejected"] == n
    assert out["masked_usertypes"] == ["*** masked ***"]
    assert out["top_after_restore"] != "oops"
    ov = out["overview"]
    assert ov["trips_raw"] == ov["bike_trips"] == out["loaded"]
    assert ov["recs_in_stream"] == 0 and ov["pending_file_count"] == 0
    assert ov["files_processed"] == ov["files_in_bucket"] > 0
    assert ov["time_to_next_pulse"] > 0
