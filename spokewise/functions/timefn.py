"""Time helpers on TIMESTAMP_NTZ (wall clock), independent of the session time zone.

``date_trunc`` on an NTZ value returns a zoned TIMESTAMP (trap T8), so the
floors below rebuild an NTZ value from its fields instead. The boundary
difference (trap T1) counts unit boundaries crossed, not whole units.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from spokewise.functions._util import col, ntz_lit

_UNIT_ALIASES = {
    # fixed values: unit spellings accepted by the dialect's dateadd/datediff
    "second": "second", "seconds": "second", "sec": "second", "s": "second",
    "minute": "minute", "minutes": "minute", "min": "minute", "mi": "minute",
    "hour": "hour", "hours": "hour", "hr": "hour", "h": "hour",
    "day": "day", "days": "day", "d": "day",
    "month": "month", "months": "month", "mon": "month", "mm": "month",
    "year": "year", "years": "year", "yr": "year", "y": "year",
}

_SECONDS_PER = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def normalize_unit(unit: str) -> str:
    """Accept plural and quoted unit names: ``hours``, ``'hour'``, ``"minute"``."""
    u = unit.strip().strip("'\"").lower()
    if u not in _UNIT_ALIASES:
        raise ValueError(f"unsupported date part: {unit!r}")
    return _UNIT_ALIASES[u]


def trunc_ntz(unit: str, ts) -> Column:
    """Floor an NTZ timestamp to ``unit``; result stays TIMESTAMP_NTZ."""
    c = col(ts)
    u = normalize_unit(unit)
    zero = F.lit(0)
    if u == "second":
        return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c),
                                    F.minute(c), F.second(c).cast("decimal(8,6)"))
    if u == "minute":
        return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c),
                                    F.minute(c), zero)
    if u == "hour":
        return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), zero, zero)
    if u == "day":
        return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), zero, zero, zero)
    if u == "month":
        return F.make_timestamp_ntz(F.year(c), F.month(c), F.lit(1), zero, zero, zero)
    return F.make_timestamp_ntz(F.year(c), F.lit(1), F.lit(1), zero, zero, zero)


def hour_floor(ts) -> Column:
    return trunc_ntz("hour", ts)


def day_floor(ts) -> Column:
    return trunc_ntz("day", ts)


def month_floor(ts) -> Column:
    return trunc_ntz("month", ts)


def _epoch_seconds_ntz(c: Column) -> Column:
    """Whole seconds since 1970-01-01 of an NTZ wall clock, as BIGINT (no zone)."""
    days = F.datediff(F.to_date(c), F.lit(_dt.date(1970, 1, 1))).cast("bigint")
    return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.floor(F.second(c)).cast("bigint")


def datediff_boundary(unit: str, start, end) -> Column:
    """Number of ``unit`` boundaries crossed from ``start`` to ``end``.

    00:00:59 -> 00:01:01 is 1 minute, although less than a whole minute passed.
    """
    u = normalize_unit(unit)
    a, b = col(start), col(end)
    if u in ("month", "year"):
        months = (F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))
        return (months if u == "month" else F.year(b) - F.year(a)).cast("bigint")
    if u == "day":
        return F.datediff(F.to_date(b), F.to_date(a)).cast("bigint")
    step = _SECONDS_PER[u]
    fa, fb = _epoch_seconds_ntz(a), _epoch_seconds_ntz(b)
    return (F.floor(fb / step) - F.floor(fa / step)).cast("bigint")


def seconds_until(now, ts) -> Column:
    """``timestampdiff(second, now, ts)`` with ``now`` injectable."""
    return datediff_boundary("second", now, ts)


def dateadd(unit: str, n, ts) -> Column:
    """``dateadd(unit, n, ts)``; unit may be plural or quoted."""
    u = normalize_unit(unit)
    amount = n if isinstance(n, Column) else F.lit(n)
    return F.timestamp_add(u.upper(), amount, col(ts))


def month_range(ts, month_start: str) -> Column:
    """``date_trunc('month', ts) = 'YYYY-MM-01'`` rewritten as a half-open range.

    The range form reaches the Parquet scan as ``PushedFilters``; the
    truncation form stays an opaque filter.
    """
    d = _dt.date.fromisoformat(month_start[:10])
    if d.day != 1:
        return F.lit(False)
    nxt = _dt.date(d.year + (d.month == 12), d.month % 12 + 1, 1)
    lo = _dt.datetime(d.year, d.month, 1)
    hi = _dt.datetime(nxt.year, nxt.month, 1)
    c = col(ts)
    return (c >= ntz_lit(lo)) & (c < ntz_lit(hi))
