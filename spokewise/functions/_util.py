from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def ntz_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal from text or a naive datetime, independent of any time zone.

    ``F.lit(datetime)`` goes through the Python process zone and the
    session zone; a text literal cast to NTZ goes through neither.
    """
    import datetime as _dt
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        value = value.isoformat() + " 00:00:00"
    return F.lit(str(value)).cast("timestamp_ntz")


def utc_ntz(instant: Column) -> Column:
    """An instant as UTC wall-clock time (TIMESTAMP_NTZ), whatever the session zone is."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), ntz_lit("1970-01-01 00:00:00"))


def utc_now() -> Column:
    """The present UTC wall-clock time as a literal."""
    import datetime as _dt
    return ntz_lit(_dt.datetime.now(_dt.timezone.utc))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where ``body`` uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
