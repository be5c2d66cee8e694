"""Continuous ingest of staged files (T-1, T-2, T-10, T-11).

A pipe is a Structured Streaming file source feeding a Parquet file
sink. The sink's ``_spark_metadata`` log is the commit point: a file is
part of the raw table exactly once, even when a micro-batch is retried
after an executor loss, and a restarted query resumes from its
checkpoint. Every row keeps its source file and load time, and rows that
fail to parse are kept in the ``_ok=false`` folders, so the load
history (copy_history) is an aggregate over the raw table itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    LongType, StringType, StructField, StructType, TimestampNTZType, VariantType,
)

from spokewise import schemas
from spokewise.functions._util import ntz_lit, utc_ntz
from spokewise.sources.formats import CsvFormat
from spokewise.sources.loader import CORRUPT, validate
from spokewise.sources.stage import list_stage, plain_path

# fixed value: consumer and pipe cadence of the reference
DEFAULT_TRIGGER = "1 minute"

RAW_JSON_SCHEMA = StructType([
    StructField("v", VariantType(), True),
    StructField("_error", StringType(), True),
    StructField("_file", StringType(), True),
    StructField("_load_time", TimestampNTZType(), True),
    StructField("_commit", LongType(), True),
    StructField("_ok", StringType(), True),
])


def _commit() -> "F.Column":
    """Number of the micro-batch that a row is committed with: its trigger time in microseconds, one for all rows."""
    return F.unix_micros(F.current_timestamp())


def _load_time(load_time) -> "F.Column":
    if load_time is not None:
        return ntz_lit(load_time)
    return utc_ntz(F.current_timestamp())


def json_source(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None,
                clean_source: str | None = None, archive_dir: str | None = None,
                load_time=None) -> DataFrame:
    r = spark.readStream.format("json").option("singleVariantColumn", "v")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if clean_source:
        r = r.option("cleanSource", clean_source)
        if archive_dir:
            r = r.option("sourceArchiveDir", archive_dir)
    s = r.load(landing)
    ok = F.col("v").isNotNull()
    return s.select("v", F.when(~ok, F.lit("malformed JSON")).alias("_error"),
                    plain_path("_metadata.file_path").alias("_file"),
                    _load_time(load_time).alias("_load_time"), _commit().alias("_commit"), ok.alias("_ok"))


def csv_source(spark: SparkSession, landing: str, schema: StructType, fmt: CsvFormat,
               max_files_per_trigger: int | None = None, load_time=None) -> DataFrame:
    """Typed rows plus ``_ok``/``_error``: the same validation as the bulk load.

    With a quote character a file is read by one task, so that enclosed line ends stay
    in their field. A stream cannot apply an escape character outside quotes.
    """
    if fmt.escape_unenclosed:
        raise ValueError("escape_unenclosed is for bulk loads; a pipe's format cannot have it")
    read_schema = StructType(list(schemas.all_string(schema).fields) + [StructField(CORRUPT, StringType())])
    r = (spark.readStream.schema(read_schema).options(**fmt.reader_options())
         .option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", str(fmt.quote is not None).lower()))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    parsed = validate(r.csv(landing), schema, fmt.error_on_column_count_mismatch,
                      fmt.extra_null_tokens(), fmt.timestamp_formats)
    return parsed.withColumn("_load_time", _load_time(load_time)).withColumn("_commit", _commit())


def start_pipe(source: DataFrame, raw_path: str, checkpoint: str, available_now: bool = False,
               trigger: str = DEFAULT_TRIGGER) -> StreamingQuery:
    """``create pipe ... auto_ingest=true as copy into raw from @stage``.

    Raw rows lie in a folder per commit, so that readers that know which commits
    they have seen read the others only. Commit numbers rise: a pipe starts above the
    last one, whatever the clock says.
    """
    above = F.lit(last_commit(source.sparkSession, raw_path) + 1)
    w = (source.withColumn("_commit", F.greatest("_commit", above)).writeStream.format("parquet")
         .option("path", raw_path).option("checkpointLocation", checkpoint)
         .partitionBy("_commit", "_ok").outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def run_pipe_once(source: DataFrame, raw_path: str, checkpoint: str, load_time=None) -> int:
    """Process every file present now, in as many micro-batches as the source allows, then bring the
    pipe's load ledger up to date. Returns the number of rows parsed, as the ledger counts them."""
    q = start_pipe(source, raw_path, checkpoint, available_now=True)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return update_pipe_ledger(source.sparkSession, raw_path, checkpoint, load_time)


LEDGER_SOURCE_SCHEMA = StructType([
    StructField("_error", StringType(), True),
    StructField("_file", StringType(), True),
    StructField("_load_time", TimestampNTZType(), True),
    StructField("_ok", StringType(), True),
])

PIPE_LEDGER_SCHEMA = StructType([
    StructField("_file", StringType(), True),
    StructField("last_load_time", TimestampNTZType(), True),
    StructField("row_parsed", LongType(), True),
    StructField("row_count", LongType(), True),
    StructField("error_count", LongType(), True),
    StructField("first_error", StringType(), True),
])


NO_ROWS = -1   # ledger batch of the files without rows


def pipe_ledger_path(raw_path: str) -> str:
    return raw_path.rstrip("/") + "_ledger"


def last_commit(spark: SparkSession, raw_path: str) -> int:
    """The highest commit number in the raw table; 0 without any."""
    files = raw_files(spark, raw_path, good_only=False)
    return 0 if files is None else files.agg(F.max("commit")).first()[0] or 0


def _truncated_path(raw_path: str) -> str:
    return raw_path.rstrip("/") + "_truncated"


def truncated_commit(spark: SparkSession, raw_path: str) -> int:
    """Commits up to this one were removed by ``truncate_raw``; 0 if there was none."""
    from spokewise.sources import fsio
    path = _truncated_path(raw_path)
    return int(fsio.read_text(spark, path)) if fsio.exists(spark, path) else 0


def truncate_raw(spark: SparkSession, raw_path: str) -> int:
    """``truncate table raw`` of a pipe's table: readers, peeks and consumers started from now on see later
    commits only (a partition filter). Rows that a consumer had not taken are gone for it; files that the
    pipe has loaded are not loaded again, and the load history stays. Returns the last commit removed.
    """
    from spokewise.sources import fsio
    commit = last_commit(spark, raw_path)
    fsio.write_text(spark, _truncated_path(raw_path), str(commit), overwrite=True)
    return commit


def _file_counts(rows: DataFrame) -> DataFrame:
    ok = F.col("_ok") == F.lit("true")
    return (rows.groupBy("_file")
            .agg(F.max("_load_time").alias("last_load_time"),
                 F.count(F.lit(1)).alias("row_parsed"),
                 F.sum(F.when(ok, 1).otherwise(0)).cast("long").alias("row_count"),
                 F.sum(F.when(ok, 0).otherwise(1)).cast("long").alias("error_count"),
                 F.min("_error").alias("first_error")))


SOURCE_LOG = "path string, timestamp bigint, batchId bigint"


def taken_files(spark: SparkSession, pipe_checkpoint: str) -> DataFrame:
    """(_file): files of the batches that the pipe has committed, with or without rows.

    From the log that the file source keeps in the checkpoint, a line per file, read as a table.
    """
    from spokewise.sources import fsio
    root = pipe_checkpoint.rstrip("/")
    log = f"{root}/sources/0"
    done = [int(n) for n in fsio.list_names(spark, f"{root}/commits") if n.isdigit()]
    if not done or not fsio.has_data_files(spark, log):
        return spark.createDataFrame([], "_file string")
    line = F.from_json("value", SOURCE_LOG)
    path = _bare(plain_path("l.path"))
    return (spark.read.text(log).where(F.startswith("value", F.lit("{"))).select(line.alias("l"))
            .where(F.col("l.batchId") <= max(done)).select(path.alias("_file")).distinct())


def _count_empty_files(spark: SparkSession, raw_path: str, pipe_checkpoint: str, load_time) -> None:
    """A ledger row for each file that the pipe took and that had no row (no bytes, or a header only)."""
    taken = taken_files(spark, pipe_checkpoint)
    known = read_pipe_ledger(spark, raw_path).select("_file")
    zero = [F.lit(0).cast("long").alias(c) for c in ("row_parsed", "row_count", "error_count")]
    (taken.join(known, "_file", "left_anti")
     .select("_file", _load_time(load_time).alias("last_load_time"), *zero, F.lit(None).cast("string").alias("first_error"),
             F.lit(NO_ROWS).cast("long").alias("batch_id"))
     .write.mode("append").partitionBy("batch_id").parquet(pipe_ledger_path(raw_path)))


def update_pipe_ledger(spark: SparkSession, raw_path: str, pipe_checkpoint: str, load_time=None) -> int:
    """Per-file load counts of the pipe, kept incrementally (copy_history, S12/T-13); returns the rows
    parsed in the newly counted files.

    A change stream over the raw sink reads only the four bookkeeping
    columns of newly committed raw files and writes one row per loaded file
    and batch (``batch_id=N`` overwritten on replay). History, pending-file
    and purge queries read this small table instead of scanning the raw rows.
    """
    out = pipe_ledger_path(raw_path)
    batches: list[int] = []

    def process(df: DataFrame, batch_id: int) -> None:
        (_file_counts(df).withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(out))
        batches.append(batch_id)

    q = (spark.readStream.schema(LEDGER_SOURCE_SCHEMA).parquet(raw_path).writeStream
         .foreachBatch(process).option("checkpointLocation", pipe_checkpoint.rstrip("/") + "_ledger")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    _count_empty_files(spark, raw_path, pipe_checkpoint, load_time)
    if not batches:
        return 0
    counted = spark.read.schema(StructType([*PIPE_LEDGER_SCHEMA.fields, StructField("batch_id", LongType())])).parquet(out).where(
        F.col("batch_id").isin(batches))  # partition pruned
    return counted.agg(F.sum("row_parsed")).first()[0] or 0


def read_pipe_ledger(spark: SparkSession, raw_path: str) -> DataFrame:
    """One row per loaded file (rows of a file are summed over ledger batches)."""
    from spokewise.sources.fsio import has_data_files
    path = pipe_ledger_path(raw_path)
    if not has_data_files(spark, path):
        return spark.createDataFrame([], PIPE_LEDGER_SCHEMA)
    led = spark.read.schema(PIPE_LEDGER_SCHEMA).parquet(path)
    return (led.groupBy("_file")
            .agg(F.max("last_load_time").alias("last_load_time"), F.sum("row_parsed").alias("row_parsed"),
                 F.sum("row_count").alias("row_count"), F.sum("error_count").alias("error_count"),
                 F.min("first_error").alias("first_error")))


def read_raw(spark: SparkSession, raw_path: str, schema: StructType = RAW_JSON_SCHEMA,
             include_rejects: bool = False, skip_failed_files: bool = True,
             raw_file: str | None = None, commits: list[int] | None = None) -> DataFrame:
    """Batch read of the committed raw rows (the reader honours ``_spark_metadata``).

    A pipe skips files with errors (T18): good rows of a file that also had a
    rejected row are left out, unless ``skip_failed_files`` is off. ``raw_file`` names a
    column for each row's raw file; ``commits`` keeps the rows of these commits (pruned).
    """
    df = spark.read.schema(schema).parquet(raw_path)
    if raw_file:
        df = df.withColumn(raw_file, F.col("_metadata.file_path"))
    df = df.where(F.col("_commit") > truncated_commit(spark, raw_path))
    if commits is not None:
        df = df.where(F.col("_commit").isin(commits) if commits else F.lit(False))
    if include_rejects:
        return df
    good = df.where(F.col("_ok") == F.lit("true"))
    return good.join(failed_files(spark, raw_path), "_file", "left_anti") if skip_failed_files else good


def failed_files(spark: SparkSession, raw_path: str) -> DataFrame:
    """(_file): source files with a rejected row, from the ``_ok=false`` folders alone.

    A source file is read in one micro-batch and the sink commits all rows of a batch
    together, so whoever sees a row of a file also sees whether the file failed.
    """
    return (spark.read.schema(FAILED_SCHEMA).parquet(raw_path).where(F.col("_ok") == F.lit("false"))
            .select("_file").distinct())


FAILED_SCHEMA = StructType([StructField("_file", StringType()), StructField("_commit", LongType()),
                            StructField("_ok", StringType())])

def raw_files(spark: SparkSession, raw_path: str, good_only: bool = True) -> DataFrame | None:
    """(raw_file, commit) of the raw table's files (with good rows), by a listing; None before the first commit.

    Files of a micro-batch that failed are listed too: this tells where rows may be, the sink's log which count.
    """
    from spokewise.sources import fsio
    if not fsio.exists(spark, raw_path):
        return None
    commit = F.regexp_extract("name", r"^_commit=(\d+)/", 1)
    files = list_stage(spark, raw_path).where(commit != "")
    if good_only:
        files = files.where(F.contains("name", F.lit("/_ok=true/")))
    return files.select(F.col("path").alias("raw_file"), commit.cast("long").alias("commit"))


def _bare(path: "F.Column") -> "F.Column":
    """``file:///x`` as ``file:/x``, the way rows name their file."""
    return F.regexp_replace(path, "^([a-z0-9+.-]+):///", "$1:/")


def pipe_history(per_file: DataFrame, table_name: str) -> DataFrame:
    """copy_history of a pipe from per-file counts (``read_pipe_ledger``)."""
    return (per_file
            .select(F.lit(table_name).alias("table_name"),
                    F.regexp_extract("_file", r"^(.*/)[^/]*$", 1).alias("stage_location"),
                    F.regexp_extract("_file", r"([^/]*)$", 1).alias("file_name"),
                    "last_load_time", "row_parsed", "row_count", "error_count", "first_error",
                    F.when(F.col("error_count") == 0, "LOADED").otherwise("PARTIALLY_LOADED").alias("status"),
                    F.col("_file").alias("file_path")))


__all__ = ["DEFAULT_TRIGGER", "RAW_JSON_SCHEMA", "csv_source", "json_source",
           "pipe_history", "read_pipe_ledger", "read_raw", "run_pipe_once",
           "start_pipe", "update_pipe_ledger"]
