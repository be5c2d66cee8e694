"""Day-partitioned JSON unload.

The reference unloads one day at a time: one query for the list of days,
then one ``copy into @stage/<day>`` per day, each sorted by start time.
Here the whole range is one job: range-partition on (day, starttime),
sort within partitions, and let the writer split by ``day``. A hot day is
spread over several tasks; because the range partitions are ordered, the
part files of a day, read in name order, are sorted by start time.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spokewise import schemas
from spokewise.functions._util import col, ntz_lit
from spokewise.functions.jsonfn import JSON_TS_FORMAT


def day_range(ts, start: str | None, stop: str | None) -> Column:
    """``to_date(ts) >= start and to_date(ts) <= stop`` as a half-open timestamp range; None: no bound.

    The range form is a plain comparison on the column, so it is pushed
    into the Parquet scan; ``to_date(ts)`` would not be.
    """
    c, inside = col(ts), F.lit(True)
    if start is not None:
        inside = c >= ntz_lit(_dt.datetime.fromisoformat(start[:10]))
    if stop is not None:
        below = c < ntz_lit(_dt.datetime.fromisoformat(stop[:10]) + _dt.timedelta(days=1))
        inside = below if start is None else inside & below
    return inside


def distinct_days(trips: DataFrame, start: str, stop: str, ts: str = "starttime") -> DataFrame:
    """``select distinct to_char(date(starttime)) ... order by 1``."""
    return (trips.where(day_range(ts, start, stop))
            .select(F.date_format(F.to_date(ts), "yyyy-MM-dd").alias("day"))
            .distinct()
            .orderBy("day"))


def unload_json_by_day(trips: DataFrame, out_dir: str, start: str | None = None, stop: str | None = None,
                       keys: list[str] | None = None, ts: str = "starttime",
                       compression: str = "gzip", partitions: int | None = None,
                       mode: str = "errorifexists", max_records_per_file: int | None = None,
                       one_file_per_day: bool = False) -> int:
    """Write one JSON document per trip under ``out_dir/day=YYYY-MM-DD/``.

    Documents hold ``keys`` in order; NULL values are left out (T6) and
    timestamps are written as wall-clock text with microseconds (T7).
    ``one_file_per_day`` deals each day to one task, for days of moderate size.
    Returns the number of days that are in the range.
    """
    keys = keys or schemas.TRIP_DOC_KEYS
    docs = (trips.where(day_range(ts, start, stop))
            .select(F.date_format(F.to_date(ts), "yyyy-MM-dd").alias("day"), *keys))
    ranged = docs.repartition("day") if one_file_per_day else (docs.repartitionByRange(partitions, "day", ts) if partitions
              else docs.repartitionByRange("day", ts))
    (ranged.sortWithinPartitions("day", ts)
     .write.mode(mode).partitionBy("day")
     .option("timestampNTZFormat", JSON_TS_FORMAT)
     .option("ignoreNullFields", "true")
     .option("compression", compression)
     .option("maxRecordsPerFile", max_records_per_file or 0)
     .json(out_dir))
    return trips.where(day_range(ts, start, stop)).agg(F.count_distinct(F.to_date(ts))).first()[0]
