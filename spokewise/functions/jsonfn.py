"""JSON and VARIANT helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spokewise.functions._util import col

# fixed value: wall-clock text written for timestamps in unloaded JSON
JSON_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
JSON_OPTIONS = {"timestampNTZFormat": JSON_TS_FORMAT, "timestampFormat": JSON_TS_FORMAT,
                "ignoreNullFields": "true"}


def object_json(*names_or_pairs) -> Column:
    """``object_construct('k', v, ...)`` as JSON text; NULL-valued keys are dropped.

    Accepts column names, or ``(key, Column)`` pairs.
    """
    fields = []
    for item in names_or_pairs:
        if isinstance(item, tuple):
            k, v = item
            fields.append(col(v).alias(k))
        else:
            fields.append(F.col(item))
    return F.to_json(F.struct(*fields), JSON_OPTIONS)


def vget(v, path: str, to: str, lenient: bool = False) -> Column:
    """``v:path::type``. Strict by default (T10): a bad cast fails the job."""
    fn = F.try_variant_get if lenient else F.variant_get
    p = path if path.startswith("$") else "$." + path
    return fn(col(v), p, to)
