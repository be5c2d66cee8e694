"""Column helpers for the dialect semantics the reference relies on.

Every helper returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage codegen; none is a Python UDF.
"""

from spokewise.functions.casts import cast_round
from spokewise.functions.geo import haversine
from spokewise.functions.jsonfn import object_json, vget
from spokewise.functions.ordering import asc_nulls_largest, desc_nulls_largest
from spokewise.functions.timefn import (
    dateadd,
    datediff_boundary,
    day_floor,
    hour_floor,
    month_floor,
    month_range,
    seconds_until,
    trunc_ntz,
)

__all__ = [
    "asc_nulls_largest", "cast_round", "dateadd", "datediff_boundary", "day_floor",
    "desc_nulls_largest", "haversine", "hour_floor", "month_floor", "month_range",
    "object_json", "seconds_until", "trunc_ntz", "vget",
]
