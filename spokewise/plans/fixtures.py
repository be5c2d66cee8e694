"""Stage fixtures: files written from the adapter views, with malformed rows added by rule.

The reference reads trip CSV and JSON files from cloud stages that are
not available here. These writers produce equivalent stages from the
driver tables, as distributed Spark writes (no shuffle): one folder per
day, ``day=YYYY-MM-DD``. Malformed rows are chosen by data rules so the
oracle can say exactly which rows a load must reject:

* bad number: an ``error`` trip longer than ``BAD_SECS`` seconds gets a
  non-numeric tripduration token;
* long row: a ``click`` trip by a gender-0 rider gets an extra field;
* short row: a ``view`` trip by a gender-1 rider loses its last field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, TimestampNTZType

from spokewise import schemas

# fixed values: the data rules that make a row malformed in a fixture stage
BAD_SECS = 2500
BAD_RULE_SQL = f"(usertype = 'error' AND tripduration > {BAD_SECS})"
LONG_RULE_SQL = "(usertype = 'click' AND gender = 0)"
SHORT_RULE_SQL = "(usertype = 'view' AND gender = 1)"

CSV_TS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def bad_rule() -> Column:
    return (F.col("usertype") == "error") & (F.col("tripduration") > BAD_SECS)


def long_rule() -> Column:
    return (F.col("usertype") == "click") & (F.col("gender") == 0)


def short_rule() -> Column:
    return (F.col("usertype") == "view") & (F.col("gender") == 1)


def _token(name: str, dtype, quote: bool) -> Column:
    c = F.col(name)
    if isinstance(dtype, TimestampNTZType):
        tok = F.date_format(c, CSV_TS)
    elif isinstance(dtype, StringType) and quote:
        tok = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    elif isinstance(dtype, (IntegerType, LongType, DoubleType, StringType)):
        tok = c.cast("string")
    else:
        tok = c.cast("string")
    return F.coalesce(tok, F.lit(""))


def csv_lines(df: DataFrame, quote_strings: bool = True, corrupt: Column | None = None,
              long_row: Column | None = None, short_row: Column | None = None,
              day_col: str = "starttime") -> DataFrame:
    """(day, line) with the CSV text of each row; optional malformed rows by rule."""
    fields = df.schema.fields
    toks = [_token(f.name, f.dataType, quote_strings) for f in fields]
    if corrupt is not None:
        toks[0] = F.when(corrupt, F.concat(F.lit("x"), toks[0])).otherwise(toks[0])
    line = F.concat_ws(",", *toks)
    if short_row is not None:
        line = F.when(short_row, F.concat_ws(",", *toks[:-1])).otherwise(line)
    if long_row is not None:
        line = F.when(long_row, F.concat(line, F.lit(",extra"))).otherwise(line)
    return df.select(F.date_format(F.to_date(day_col), "yyyy-MM-dd").alias("day"), line.alias("line"))


def write_lines(lines: DataFrame, path: str, header: str | None = None,
                compression: str = "gzip") -> None:
    """Write pre-formatted lines as ``day=.../part-*.csv[.gz]`` files."""
    (lines.select("day", F.col("line").alias(header or "line"))
     .write.partitionBy("day")
     .option("sep", "\u0001").option("quote", "\u0002").option("escapeQuotes", "false")
     .option("header", "true" if header else "false")
     .option("compression", compression)
     .csv(path))


def write_trips_csv(trips: DataFrame, path: str, header: bool = False, quote_strings: bool = True,
                    corrupt: bool = False, mismatch: bool = False, compression: str = "gzip",
                    one_file_per_day: bool = False) -> None:
    """Trips as ``day=.../part-*.csv``; with ``one_file_per_day`` each day is dealt to one writing task."""
    lines = csv_lines(trips, quote_strings,
                      corrupt=bad_rule() if corrupt else None,
                      long_row=long_rule() if mismatch else None,
                      short_row=short_rule() if mismatch else None)
    if one_file_per_day:
        lines = lines.repartition("day")
    write_lines(lines, path, ",".join(trips.columns) if header else None, compression)


def write_named_csv(trips: DataFrame, path: str) -> None:
    """Plain ``trips-YYYY-MM-DD.csv`` files, one a day: part files under a name of their own."""
    from spokewise.sources import fsio
    spark = trips.sparkSession
    write_trips_csv(trips, f"{path}-parts", compression="none", one_file_per_day=True)
    parts = spark.read.text(f"{path}-parts").select(F.col("_metadata.file_path").alias("p")).distinct()
    for r in parts.select("p", F.regexp_extract("p", r"day=([0-9-]+)", 1).alias("day")).collect():   # one a day
        fsio.rename(spark, r.p, f"{path}/trips-{r.day}.csv")


def write_records_csv(trips: DataFrame, path: str, escaped: Column) -> None:
    """Plain ``day=.../part-*.txt`` files with bad-rule rows; text fields are enclosed or, where ``escaped``,
    bare with a backslash before delimiters and backslashes. A record may span lines."""
    toks = []
    for f in trips.schema.fields:
        tok = _token(f.name, f.dataType, True)
        if isinstance(f.dataType, StringType):
            bare = F.regexp_replace(F.col(f.name), r"([,\\])", r"\\$1")
            tok = F.when(escaped, F.coalesce(bare, F.lit(""))).otherwise(tok)
        toks.append(tok)
    toks[0] = F.when(bad_rule(), F.concat(F.lit("x"), toks[0])).otherwise(toks[0])
    (trips.select(F.date_format(F.to_date("starttime"), "yyyy-MM-dd").alias("day"), F.concat_ws(",", *toks).alias("value"))
     .write.partitionBy("day").text(path))


def write_trips_json(trips: DataFrame, path: str, malformed: bool = False) -> None:
    """Trip documents as JSON lines per day; with ``malformed`` the bad-rule rows are cut short."""
    from spokewise.functions.jsonfn import object_json
    doc = object_json(*schemas.TRIP_DOC_KEYS)
    if malformed:
        doc = F.when(bad_rule(), F.substring(doc, 1, 12)).otherwise(doc)
    lines = trips.select(F.date_format(F.to_date("starttime"), "yyyy-MM-dd").alias("day"),
                         doc.alias("value"))
    lines.write.partitionBy("day").option("compression", "none").text(path)


def write_weather_json(fields: DataFrame, path: str) -> None:
    """Weather documents as ``day=.../part-*.json`` files (columns = top-level keys, plus ``day``)."""
    from spokewise.functions.jsonfn import JSON_OPTIONS
    fields.write.partitionBy("day").options(**JSON_OPTIONS).option("compression", "none").json(path)


__all__ = ["BAD_RULE_SQL", "LONG_RULE_SQL", "SHORT_RULE_SQL", "csv_lines", "write_lines",
           "write_records_csv", "write_trips_csv", "write_trips_json", "write_weather_json"]
