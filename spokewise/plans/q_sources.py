"""Registered load / unload queries.

Each query writes a stage derived from the driver tables into a fresh
folder under the shared work folder (``spark.checkpoint.dir``), runs the
operator and returns the resulting table. The oracle states the
expected table straight from the Parquet tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

from spokewise import schemas
from spokewise.functions._util import ntz_lit, utc_now
from spokewise.functions.timefn import trunc_ntz
from spokewise.operators.ordered import listagg_pieces
from spokewise.plans import fixtures as fx
from spokewise.plans.adapters import V_TRIPS_SQL, table, v_trips, with_ctes
from spokewise.plans.registry import register
from spokewise.session import new_workdir
from spokewise.sources import fsio, loader
from spokewise.sources.formats import FORMAT_A, FORMAT_B, FORMAT_C, CsvFormat
from spokewise.sources.stage import day_of_path, list_stage, with_provenance
from spokewise.sources.tables import VersionedTable
from spokewise.sources.unload import distinct_days, unload_json_by_day

TRIPS = with_ctes(V_TRIPS_SQL)
TRIP_COLS = ", ".join(f.name for f in schemas.TRIPS.fields)
CSV_GZ = r".*[.]csv[.]gz"
# fixed value: the load time recorded in ledgers of registered queries
LOAD_NOW = "2024-02-01 08:00:00"


def _catalog(spark, tag):
    root = new_workdir(spark, tag)
    return root, loader.Catalog(spark, f"{root}/db")


def _csv_stage(spark, sf, root, **kw):
    stage = f"{root}/stage"
    fx.write_trips_csv(v_trips(spark, sf), stage, **kw)
    return stage


@register("csv_load_strict", ids="S1", oracle=TRIPS + f"SELECT {TRIP_COLS} FROM v_trips")
def q_csv_load_strict(spark, sf):
    root, cat = _catalog(spark, "strict")
    stage = _csv_stage(spark, sf, root, header=False)
    loader.copy_into(cat, "trips", stage, schemas.TRIPS, FORMAT_B, on_error="abort", now=LOAD_NOW)
    return cat.table("trips").read()


@register("csv_format_options", ids="S5 T23", oracle=TRIPS + f"SELECT {TRIP_COLS} FROM v_trips")
def q_csv_format_options(spark, sf):
    root, cat = _catalog(spark, "fmt")
    stage = _csv_stage(spark, sf, root, header=True, quote_strings=True)
    loader.copy_into(cat, "trips", stage, schemas.TRIPS, FORMAT_A, on_error="continue", now=LOAD_NOW)
    return cat.table("trips").read()


# fixed values: names that need each CSV option, by the rider's gender
_SPAN, _ESCAPED = '\n"north",\ngate', "a\\b, "
_NAMED = r"""CASE gender WHEN 0 THEN start_station_name || chr(10) || '"north",' || chr(10) || 'gate'
    WHEN 1 THEN 'a\b, ' || start_station_name ELSE '  ' || start_station_name END"""


@register("csv_records", ids="S5 S2 S6", oracle=TRIPS + f"""
SELECT {TRIP_COLS.replace("start_station_name", _NAMED + " AS start_station_name", 1)
        .replace("end_station_name", "CASE WHEN usertype <> 'view' THEN end_station_name END AS end_station_name", 1)}
FROM v_trips WHERE NOT {fx.BAD_RULE_SQL}""")
def q_csv_records(spark, sf):
    # enclosed line ends, quotes and delimiters; escapes outside quotes; NULL tokens; kept blanks; bad numbers rejected
    root, cat = _catalog(spark, "records")
    stage = f"{root}/stage"
    name = (F.when(F.col("gender") == 0, F.concat("start_station_name", F.lit(_SPAN)))
            .when(F.col("gender") == 1, F.concat(F.lit(_ESCAPED), "start_station_name"))
            .otherwise(F.concat(F.lit("  "), "start_station_name")))
    trips = v_trips(spark, sf).withColumn("start_station_name", name).withColumn(
        "end_station_name", F.when(F.col("usertype") == "view", F.lit("NA")).otherwise(F.col("end_station_name")))
    fx.write_records_csv(trips, stage, F.col("gender") == 1)
    fmt = CsvFormat(record_delimiter="\n", quote='"', escape_unenclosed="\\", null_if=("", "NA"))
    loader.copy_into(cat, "trips", stage, schemas.TRIPS, fmt, on_error="continue", now=LOAD_NOW)
    return cat.table("trips").read()


@register("file_pattern_filter", ids="S4", oracle=TRIPS + f"SELECT {TRIP_COLS} FROM v_trips")
def q_file_pattern_filter(spark, sf):
    root, cat = _catalog(spark, "pattern")
    stage = _csv_stage(spark, sf, root, header=True)
    unload_json_by_day(v_trips(spark, sf), f"{stage}/json")
    loader.copy_into(cat, "trips", stage, schemas.TRIPS, FORMAT_A, on_error="continue",
                     pattern=CSV_GZ, now=LOAD_NOW)
    return cat.table("trips").read()


@register("csv_load_continue", ids="S2 T18", oracle=TRIPS + f"""
SELECT {TRIP_COLS} FROM v_trips WHERE NOT {fx.BAD_RULE_SQL}""")
def q_csv_load_continue(spark, sf):
    root, cat = _catalog(spark, "continue")
    stage = _csv_stage(spark, sf, root, header=True, corrupt=True)
    loader.copy_into(cat, "trips", stage, schemas.TRIPS, FORMAT_A, on_error="continue",
                     pattern=CSV_GZ, now=LOAD_NOW)
    return cat.table("trips").read()


@register("csv_load_rejects", ids="S2", oracle=TRIPS + f"""
SELECT 'tripduration' AS error_column, 'x' || CAST(tripduration AS VARCHAR) AS tripduration_text,
       strftime(starttime, '%Y-%m-%d %H:%M:%S.%f') AS starttime_text
FROM v_trips WHERE {fx.BAD_RULE_SQL}""")
def q_csv_load_rejects(spark, sf):
    root, cat = _catalog(spark, "rejects")
    stage = _csv_stage(spark, sf, root, header=True, corrupt=True)
    loader.copy_into(cat, "trips", stage, schemas.TRIPS, FORMAT_A, on_error="continue",
                     pattern=CSV_GZ, now=LOAD_NOW, rejects_table="trips_rejects")
    rj = cat.table("trips_rejects").read()
    return rj.select(F.regexp_extract("_error", r"'([^']+)'", 1).alias("error_column"),
                     F.col("_raw_tripduration").alias("tripduration_text"),
                     F.col("_raw_starttime").alias("starttime_text"))


@register("csv_load_skip_file", ids="S3", oracle=TRIPS + f"""
SELECT {TRIP_COLS} FROM v_trips WHERE CAST(starttime AS DATE) NOT IN
  (SELECT DISTINCT CAST(starttime AS DATE) FROM v_trips WHERE {fx.BAD_RULE_SQL})""")
def q_csv_load_skip_file(spark, sf):
    # one file per day folder, so "skip the file" = "skip the day"
    root, cat = _catalog(spark, "skipfile")
    stage = _csv_stage(spark, sf, root, header=True, corrupt=True, one_file_per_day=True)
    loader.copy_into(cat, "trips", stage, schemas.TRIPS, FORMAT_A, on_error="skip_file",
                     pattern=CSV_GZ, now=LOAD_NOW)
    return cat.table("trips").read()


@register("csv_column_mismatch", ids="S6", oracle=TRIPS + f"""
SELECT tripduration, starttime, stoptime, start_station_id, start_station_name, start_station_latitude,
       start_station_longitude, end_station_id, end_station_name, end_station_latitude,
       end_station_longitude, bikeid, membership_type, usertype, birth_year,
       CASE WHEN {fx.SHORT_RULE_SQL} THEN NULL ELSE gender END AS gender
FROM v_trips""")
def q_csv_column_mismatch(spark, sf):
    root, cat = _catalog(spark, "mismatch")
    stage = _csv_stage(spark, sf, root, header=True, mismatch=True)
    loader.copy_into(cat, "trips", stage, schemas.TRIPS, FORMAT_A, on_error="continue", now=LOAD_NOW)
    return cat.table("trips").read()


@register("csv_narrow_load", ids="S7", oracle=TRIPS + """
SELECT 'end_station_id' AS error_column, count(*) AS n FROM v_trips""")
def q_csv_narrow_load(spark, sf):
    # 16-column files into the 10-column table, by position, count mismatch tolerated:
    # field 5 (a station name) lands in end_station_id and every row is rejected.
    root, cat = _catalog(spark, "narrow")
    stage = _csv_stage(spark, sf, root, header=False, quote_strings=False)
    fmt = CsvFormat(error_on_column_count_mismatch=False)
    loader.copy_into(cat, "trips_stream", stage, schemas.TRIPS_STREAM, fmt, on_error="continue",
                     now=LOAD_NOW, rejects_table="trips_stream_rejects")
    rj = cat.table("trips_stream_rejects").read()
    return (rj.groupBy(F.regexp_extract("_error", r"'([^']+)'", 1).alias("error_column"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("csv_narrow_columns", ids="S7 S6", oracle=TRIPS + f"""
SELECT tripduration, starttime, stoptime, start_station_id FROM v_trips WHERE NOT {fx.BAD_RULE_SQL}""")
def q_csv_narrow_columns(spark, sf):
    # 16-column files into a table of their first four columns: the rest of each row is cut
    root, cat = _catalog(spark, "narrowcols")
    stage = _csv_stage(spark, sf, root, header=True, corrupt=True)
    narrow = StructType(schemas.TRIPS.fields[:4])
    loader.copy_into(cat, "trips_start", stage, narrow, FORMAT_A, on_error="continue", now=LOAD_NOW)
    return cat.table("trips_start").read()


@register("csv_auto_times", ids="S5 T9", oracle=TRIPS + """
SELECT tripduration, date_trunc('second', starttime) AS iso, date_trunc('minute', stoptime) AS slash,
       date_trunc('second', starttime) AS epoch, CAST(starttime AS DATE) AS day_first, bikeid FROM v_trips""")
def q_csv_auto_times(spark, sf):
    # TIMESTAMP_FORMAT = AUTO, DATE_FORMAT = AUTO: each column's format is found from all of its tokens
    root, cat = _catalog(spark, "autotimes")
    stage = f"{root}/stage"
    t = v_trips(spark, sf)
    line = F.concat_ws(",", F.col("tripduration").cast("string"), F.date_format("starttime", "yyyy-MM-dd'T'HH:mm:ss"),
                       F.date_format("stoptime", "MM/dd/yyyy HH:mm"),
                       F.timestamp_diff("MILLISECOND", ntz_lit("1970-01-01 00:00:00"), F.col("starttime")).cast("string"),
                       F.date_format("starttime", "dd/MM/yyyy"), F.col("bikeid").cast("string"))
    t.select(F.date_format("starttime", "yyyy-MM-dd").alias("day"), line.alias("value")).write.partitionBy("day").text(stage)
    columns = StructType([StructField("tripduration", IntegerType()), StructField("iso", TimestampNTZType()),
                          StructField("slash", TimestampNTZType()), StructField("epoch", TimestampNTZType()),
                          StructField("day_first", DateType()), StructField("bikeid", IntegerType())])
    loader.copy_into(cat, "times", stage, columns, CsvFormat(timestamp_formats=("AUTO",)), now=LOAD_NOW)
    back = cat.table("times").read()
    return back.withColumn("epoch", trunc_ntz("second", "epoch"))


@register("json_load_variant", ids="S8 P3 T10", oracle=TRIPS + f"""
SELECT tripduration, starttime, stoptime, start_station_id, end_station_id, bikeid, usertype
FROM v_trips WHERE NOT {fx.BAD_RULE_SQL}""")
def q_json_load_variant(spark, sf):
    from spokewise.operators.semistructured import trip_fields
    root, cat = _catalog(spark, "jsonload")
    stage = f"{root}/stage"
    fx.write_trips_json(v_trips(spark, sf), stage, malformed=True)
    cat.table("trips_raw").create_empty(_VARIANT_SCHEMA)
    loader.copy_into(cat, "trips_raw", stage, None, "json", on_error="continue", now=LOAD_NOW)
    return trip_fields(cat.table("trips_raw").read())


def _variant_schema():
    from pyspark.sql.types import StructField, StructType, VariantType
    return StructType([StructField("v", VariantType(), True)])


_VARIANT_SCHEMA = _variant_schema()


@register("stage_listing", ids="S9", oracle=TRIPS + """
SELECT DISTINCT strftime(CAST(starttime AS DATE), '%Y-%m-%d') AS day, 'csv.gz' AS file_type FROM v_trips
UNION ALL
SELECT DISTINCT strftime(CAST(starttime AS DATE), '%Y-%m-%d') AS day, 'json.gz' AS file_type FROM v_trips""")
def q_stage_listing(spark, sf):
    root = new_workdir(spark, "listing")
    stage = _csv_stage(spark, sf, root, header=True)
    unload_json_by_day(v_trips(spark, sf), f"{stage}/json")
    ls = list_stage(spark, stage)
    return (ls.select(F.date_format(day_of_path("name"), "yyyy-MM-dd").alias("day"),
                      F.regexp_extract("name", r"\.([a-z]+\.gz)$", 1).alias("file_type"))
            .where(F.col("file_type") != "").distinct())


@register("stage_sizes", ids="S9", oracle=TRIPS + """
SELECT strftime(CAST(starttime AS DATE), '%Y-%m-%d') AS day, 1::BIGINT AS files,
       sum(octet_length(encode(start_station_name)) + 1)::BIGINT AS bytes, true AS just_written
FROM v_trips GROUP BY 1
UNION ALL SELECT NULL, 2, 0, true""")
def q_stage_sizes(spark, sf):
    # list @stage: size and time of every file, of two without bytes too
    root = new_workdir(spark, "sizes")
    stage = f"{root}/stage"
    day = F.date_format(F.to_date("starttime"), "yyyy-MM-dd").alias("day")
    (v_trips(spark, sf).select(day, F.col("start_station_name").alias("value")).repartition("day")
     .write.partitionBy("day").text(stage))
    for name in ("empty.csv", "late/empty.json"):
        fsio.write_text(spark, f"{stage}/{name}", "")
    age = F.abs(F.timestamp_diff("SECOND", F.col("last_modified"), utc_now()))
    return (list_stage(spark, stage).groupBy(F.date_format(day_of_path("name"), "yyyy-MM-dd").alias("day"))
            .agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"),
                 F.bool_and(age < 3600).alias("just_written")))


@register("stage_query", ids="S10", oracle=TRIPS + "SELECT CAST(tripduration AS VARCHAR) AS c1 FROM v_trips")
def q_stage_query(spark, sf):
    # select $1 from @stage: the first field of every staged row, read in place
    root = new_workdir(spark, "stageq")
    stage = _csv_stage(spark, sf, root, header=False, quote_strings=False)
    return (spark.read.options(**FORMAT_C.reader_options()).csv(stage)
            .select(F.col("_c0").alias("c1")))


@register("stage_query_json", ids="S10 S8 O5", oracle=TRIPS + """
SELECT least(10, count(*)) AS documents, least(10, count(*)) AS staged, true AS whole FROM v_trips""")
def q_stage_query_json(spark, sf):
    # select $1 from @stage (a JSON stage) limit 10: whole documents, any ten; how many, how many of them are staged
    root = new_workdir(spark, "stagejson")
    stage = f"{root}/stage"
    fx.write_trips_json(v_trips(spark, sf), stage)
    docs = spark.read.format("json").option("singleVariantColumn", "v").load(stage).select(F.to_json("v").alias("doc"))
    ten = docs.limit(10)
    staged = ten.join(docs.distinct(), "doc", "left_semi").count()
    return ten.agg(F.count(F.lit(1)).alias("documents"), F.lit(staged).cast("long").alias("staged"),
                   F.bool_and(F.col("doc").startswith("{") & F.col("doc").contains("tripduration")).alias("whole"))


@register("file_provenance", ids="S11", oracle=TRIPS + """
SELECT strftime(CAST(starttime AS DATE), '%Y-%m-%d') AS file_day, count(*) AS n FROM v_trips GROUP BY 1""")
def q_file_provenance(spark, sf):
    root = new_workdir(spark, "prov")
    stage = _csv_stage(spark, sf, root, header=False)
    rows = with_provenance(spark.read.options(**FORMAT_B.reader_options()).schema(schemas.TRIPS).csv(stage))
    return (rows.groupBy(F.date_format(day_of_path("_file"), "yyyy-MM-dd").alias("file_day"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("distinct_files", ids="P15", oracle=TRIPS + """
SELECT DISTINCT strftime(CAST(starttime AS DATE), '%Y-%m-%d') AS file_day FROM v_trips""")
def q_distinct_files(spark, sf):
    root = new_workdir(spark, "dfiles")
    stage = _csv_stage(spark, sf, root, header=False)
    rows = with_provenance(spark.read.options(**FORMAT_B.reader_options()).schema(schemas.TRIPS).csv(stage))
    files = rows.select("_file").distinct()
    return files.select(F.date_format(day_of_path("_file"), "yyyy-MM-dd").alias("file_day")).distinct()


@register("count_distinct_files", ids="A7", oracle=TRIPS + f"""
SELECT count(DISTINCT CAST(starttime AS DATE)) AS files_in_bucket, count(*) AS rows FROM v_trips""")
def q_count_distinct_files(spark, sf):
    # count(distinct metadata$filename): files holding rows, of which the stage has one per day
    root = new_workdir(spark, "cdfiles")
    stage = _csv_stage(spark, sf, root, header=False, one_file_per_day=True)
    rows = with_provenance(spark.read.options(**FORMAT_B.reader_options()).schema(schemas.TRIPS).csv(stage))
    return rows.agg(F.count_distinct("_file").alias("files_in_bucket"), F.count(F.lit(1)).alias("rows"))


@register("listagg_files", ids="A10 T16", oracle=TRIPS + """
SELECT (r - 1) // 8 AS piece, count(*) AS n, string_agg('.*' || name, '|' ORDER BY name) AS purge_pattern
FROM (SELECT name, row_number() OVER (ORDER BY name) AS r
      FROM (SELECT DISTINCT 'trips-' || strftime(CAST(starttime AS DATE), '%Y-%m-%d') || '.csv' AS name FROM v_trips))
GROUP BY 1""")
def q_listagg_files(spark, sf):
    # listagg('.*' || name, '|') over the names of the files loaded without errors, in pieces of eight names
    root, cat = _catalog(spark, "listagg")
    stage = f"{root}/stage"
    fx.write_named_csv(v_trips(spark, sf), stage)
    loader.copy_into(cat, "trips", stage, schemas.TRIPS, FORMAT_B, on_error="abort", now=LOAD_NOW)
    names = cat.load_history("trips").where(F.col("error_count") == 0).select(
        F.concat(F.lit(".*"), "file_name").alias("purge_pattern"))
    return listagg_pieces(names, "purge_pattern", "|", per_piece=8)


@register("load_ledger", ids="S12", oracle=TRIPS + f"""
SELECT strftime(CAST(starttime AS DATE), '%Y-%m-%d') AS file_day,
       count(*) AS row_parsed,
       count(*) FILTER (WHERE NOT {fx.BAD_RULE_SQL}) AS row_count,
       count(*) FILTER (WHERE {fx.BAD_RULE_SQL}) AS error_count,
       CASE WHEN count(*) FILTER (WHERE {fx.BAD_RULE_SQL}) = 0 THEN 'LOADED' ELSE 'PARTIALLY_LOADED' END AS status,
       'trips' AS table_name
FROM v_trips GROUP BY 1""")
def q_load_ledger(spark, sf):
    root, cat = _catalog(spark, "ledger")
    stage = _csv_stage(spark, sf, root, header=True, corrupt=True)
    loader.copy_into(cat, "trips", stage, schemas.TRIPS, FORMAT_A, on_error="continue",
                     pattern=CSV_GZ, now=LOAD_NOW)
    h = cat.load_history("trips", start_time="2024-02-01 07:00:00")
    return (h.groupBy(F.date_format(day_of_path("file_path"), "yyyy-MM-dd").alias("file_day"), "table_name")
            .agg(F.sum("row_parsed").alias("row_parsed"), F.sum("row_count").alias("row_count"),
                 F.sum("error_count").alias("error_count"),
                 F.max("status").alias("status")))


@register("load_once", ids="S13", oracle=TRIPS + f"SELECT {TRIP_COLS} FROM v_trips")
def q_load_once(spark, sf):
    root, cat = _catalog(spark, "once")
    stage = _csv_stage(spark, sf, root, header=False)
    loader.copy_into(cat, "trips", stage, schemas.TRIPS, FORMAT_B, on_error="abort", now=LOAD_NOW)
    again = loader.copy_into(cat, "trips", stage, schemas.TRIPS, FORMAT_B, on_error="abort", now=LOAD_NOW)
    assert again.files == 0, "a loaded file was loaded again"
    return cat.table("trips").read()


@register("truncate_reload", ids="S19 T17", oracle=TRIPS + f"SELECT {TRIP_COLS}, 0 AS left_by_truncate FROM v_trips")
def q_truncate_reload(spark, sf):
    root, cat = _catalog(spark, "trunc")
    stage = _csv_stage(spark, sf, root, header=False)
    loader.copy_into(cat, "trips", stage, schemas.TRIPS, FORMAT_B, on_error="abort", now=LOAD_NOW)
    loader.truncate(cat, "trips")
    left = cat.table("trips").read().count()
    loader.copy_into(cat, "trips", stage, schemas.TRIPS, FORMAT_B, on_error="abort", now=LOAD_NOW)
    return cat.table("trips").read().withColumn("left_by_truncate", F.lit(left).cast("int"))


@register("load_after_restore", ids="S13 V3", oracle=TRIPS + f"""
SELECT {TRIP_COLS}, (SELECT count(*) FROM v_trips) AS loaded_again FROM v_trips""")
def q_load_after_restore(spark, sf):
    # rows undone by a restore are pending again
    root, cat = _catalog(spark, "loadrestore")
    stage = _csv_stage(spark, sf, root, header=False)
    loader.copy_into(cat, "trips", stage, schemas.TRIPS, FORMAT_B, now=LOAD_NOW)
    t = cat.table("trips")
    t.restore_before(t.log()[-1].query_id)
    again = loader.copy_into(cat, "trips", stage, schemas.TRIPS, FORMAT_B, now=LOAD_NOW)
    return t.read().withColumn("loaded_again", F.lit(again.rows_loaded).cast("long"))


@register("load_after_recreate", ids="S13 S18", oracle=TRIPS + f"""
SELECT {TRIP_COLS}, (SELECT count(*) FROM v_trips) AS loaded_again FROM v_trips""")
def q_load_after_recreate(spark, sf):
    # a table that was dropped and created again has loaded nothing
    root, cat = _catalog(spark, "loadcreate")
    stage = _csv_stage(spark, sf, root, header=False)
    loader.copy_into(cat, "trips", stage, schemas.TRIPS, FORMAT_B, now=LOAD_NOW)
    t = cat.table("trips")
    t.drop()
    t.create_empty(schemas.TRIPS)
    again = loader.copy_into(cat, "trips", stage, schemas.TRIPS, FORMAT_B, now=LOAD_NOW)
    return t.read().withColumn("loaded_again", F.lit(again.rows_loaded).cast("long"))


@register("unload_json_by_day", ids="S14 O4 F11 T6 T7", oracle=TRIPS + """
SELECT strftime(CAST(starttime AS DATE), '%Y-%m-%d') AS day, tripduration, starttime, stoptime,
       start_station_id, start_station_name, start_station_latitude, start_station_longitude,
       end_station_id, end_station_name, end_station_latitude, end_station_longitude, bikeid, usertype
FROM v_trips""")
def q_unload_json_by_day(spark, sf):
    root = new_workdir(spark, "unload")
    out = f"{root}/stage"
    unload_json_by_day(v_trips(spark, sf), out)
    doc_schema = schemas.TRIPS.__class__([f for f in schemas.TRIPS.fields if f.name in schemas.TRIP_DOC_KEYS])
    from spokewise.functions.jsonfn import JSON_TS_FORMAT
    back = (spark.read.schema(doc_schema).option("timestampNTZFormat", JSON_TS_FORMAT).json(out)
            .select(F.date_format(day_of_path(F.col("_metadata.file_path")), "yyyy-MM-dd").alias("day"),
                    *schemas.TRIP_DOC_KEYS))
    return back


@register("distinct_days", ids="S15 F8 F9 P9", oracle=TRIPS + """
SELECT DISTINCT strftime(CAST(starttime AS DATE), '%Y-%m-%d') AS day FROM v_trips
WHERE CAST(starttime AS DATE) >= DATE '2024-01-01' AND CAST(starttime AS DATE) <= DATE '2024-12-31'
ORDER BY 1""")
def q_distinct_days(spark, sf):
    return distinct_days(v_trips(spark, sf), "2024-01-01", "2024-12-31")


@register("insert_values", ids="S16 D3", oracle="""
SELECT CAST(event_id AS INTEGER) AS col1, event_type AS col2 FROM events
UNION ALL SELECT * FROM (VALUES (-1, 'first added row'), (-2, 'second added row')) v(col1, col2)""")
def q_insert_values(spark, sf):
    root = new_workdir(spark, "insv")
    t = VersionedTable(spark, f"{root}/testtable", "testtable")
    e = table(spark, sf, "events")
    t.create(e.select(F.col("event_id").cast("int").alias("col1"), F.col("event_type").alias("col2")))
    rows = spark.createDataFrame([(-1, "first added row"), (-2, "second added row")], schemas.TESTTABLE)
    t.append(rows, "two literal rows")
    return t.read()


@register("bind_insert", ids="P17 S16", oracle="""
SELECT CAST(event_id AS INTEGER) AS col1, event_type AS col2 FROM events
UNION ALL SELECT -3, 'bound row'""")
def q_bind_insert(spark, sf):
    # values bound by name, as arguments of spark.sql
    root = new_workdir(spark, "bind")
    t = VersionedTable(spark, f"{root}/testtable", "testtable")
    e = table(spark, sf, "events")
    t.create(e.select(F.col("event_id").cast("int").alias("col1"), F.col("event_type").alias("col2")))
    row = spark.sql("SELECT CAST(:col1 AS INT) AS col1, CAST(:col2 AS STRING) AS col2",
                    args={"col1": -3, "col2": "bound row"})
    t.append(row, "one row from named parameters")
    return t.read()


@register("insert_select", ids="S17 D3", oracle=TRIPS + """
SELECT tripduration, starttime, stoptime, start_station_id, end_station_id, bikeid, usertype FROM v_trips""")
def q_insert_select(spark, sf):
    root = new_workdir(spark, "inss")
    t = VersionedTable(spark, f"{root}/bike_trips", "bike_trips")
    t.create_empty(schemas.BIKE_TRIPS)
    t.append(v_trips(spark, sf).select(*[f.name for f in schemas.BIKE_TRIPS.fields]),
             "insert into bike_trips select ... from trips")
    return t.read()


@register("ctas_replace", ids="S18", oracle=TRIPS + """
SELECT start_station_name AS station, count(*) AS rides FROM v_trips GROUP BY 1""")
def q_ctas_replace(spark, sf):
    root = new_workdir(spark, "ctas")
    t = VersionedTable(spark, f"{root}/station_rides", "station_rides")
    trips = v_trips(spark, sf)
    t.create_empty(StructType([StructField("station", StringType()), StructField("rides", LongType())]),
                   "create table station_rides (station string, rides bigint)")
    t.replace(trips.groupBy(F.col("start_station_name").alias("station"))
              .agg(F.count(F.lit(1)).alias("rides")),
              "create or replace table station_rides as (select ...)", op="create")
    return t.read()


@register("sample_limit", ids="S21 O5")
def q_sample_limit(spark, sf):
    # select * from trips limit 20: any 20 rows; rows-only check (no order is implied)
    return v_trips(spark, sf).limit(20)


@register("sample_members", ids="S21 O5", oracle=TRIPS + """
SELECT least(20, count(*)) AS sampled, least(20, count(*)) AS members FROM v_trips""")
def q_sample_members(spark, sf):
    # the sample itself is arbitrary: its size, and how many of its rows are rows of the table
    trips = v_trips(spark, sf)
    s = trips.limit(20)
    key = F.xxhash64(*trips.columns).alias("h")
    members = s.select(key).join(trips.select(key).distinct(), "h", "left_semi")
    return s.agg(F.count(F.lit(1)).alias("sampled")).select(
        "sampled", F.lit(members.count()).cast("long").alias("members"))
