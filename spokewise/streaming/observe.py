"""Pipeline monitoring (T-5, T-11 ... T-16, J2, J4).

Every view here is a Spark query over data the pipeline already writes:
the landing listing, the raw sink, the consumers' file logs and the run
log. ``now`` is always an argument, so the views are reproducible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokewise.functions import dateadd, seconds_until
from spokewise.functions._util import ntz_lit
from spokewise.sources.stage import list_stage, plain_path
from spokewise.sources.tables import has_data_files
from spokewise.streaming.consumers import (
    RAW_FILE, RUN_LOG_SCHEMA, Consumer, next_run_path, read_run_log, run_log_path,
)
from spokewise.streaming.ingest import (
    RAW_JSON_SCHEMA, pipe_history, raw_files, read_pipe_ledger, read_raw, truncated_commit,
)


def _ts(now):
    return ntz_lit(now)


OPEN_COMMITS = 1000   # more open commits than this are not listed one by one in the filter


def open_commits(spark: SparkSession, consumer: Consumer, raw_path: str) -> list[int] | None:
    """Commits that hold a raw file the consumer has not consumed; None where too many do (or nothing is committed).

    From a listing of the raw files and the consumer's file log; no raw row is read.
    """
    files = raw_files(spark, raw_path)
    if files is None:
        return None
    if has_data_files(spark, consumer.files_log):
        done = spark.read.parquet(consumer.files_log).select(plain_path(RAW_FILE).alias("raw_file"))
        files = files.where(F.col("commit") > truncated_commit(spark, raw_path)).withColumn("raw_file", plain_path("raw_file")).join(done, "raw_file", "left_anti")
    found = [r.commit for r in files.select("commit").distinct().limit(OPEN_COMMITS + 1).collect()]
    return sorted(found) if len(found) <= OPEN_COMMITS and None not in found else None


def peek(spark: SparkSession, consumer: Consumer, raw_path: str, skip_failed_files: bool = True) -> DataFrame:
    """``select * from stream``: rows the consumer has not consumed yet, without consuming them.

    Only commits with something left to consume are read (``_commit`` is a partition filter);
    in these, raw rows whose raw file is absent from the consumer's file log. The log has one row
    per source and raw file, so the answer is exact also when a bounded batch has consumed some
    of the raw files of a source file.
    """
    raw = read_raw(spark, raw_path, skip_failed_files=skip_failed_files, raw_file=RAW_FILE,
                   commits=open_commits(spark, consumer, raw_path))
    if has_data_files(spark, consumer.files_log):
        done = spark.read.parquet(consumer.files_log).select(RAW_FILE).distinct()
        raw = raw.join(done, RAW_FILE, "left_anti")
    return raw.drop(RAW_FILE)


def pending_files(spark: SparkSession, landing: str, raw_path: str, pattern: str | None = None) -> DataFrame:
    """Files in the landing folder the pipe has not loaded yet (``pendingFileCount``).

    The listing is anti-joined with the pipe's per-file ledger (one row per
    file), not with the raw rows.
    """
    listing = list_stage(spark, landing, pattern)
    loaded = read_pipe_ledger(spark, raw_path).select(F.col("_file").alias("path"))
    return listing.join(loaded, "path", "left_anti")


def load_history(spark: SparkSession, raw_path: str, table_name: str, now, hours: int = 1) -> DataFrame:
    """``copy_history(table_name, start_time => dateadd(hour, -hours, now))`` (T-13)."""
    since = dateadd("hour", -hours, _ts(now))
    return pipe_history(read_pipe_ledger(spark, raw_path), table_name).where(F.col("last_load_time") >= since)


def purge_candidates(spark: SparkSession, raw_path: str, table_name: str, landing: str, now,
                     hours: int = 10) -> DataFrame:
    """Files safe to remove (J2): loaded without errors in the last ``hours`` and still staged.

    An equality join on the full path replaces the reference's regex built
    from a ``listagg`` of names (T16); an empty candidate list is a no-op.
    """
    h = load_history(spark, raw_path, table_name, now, hours).where(F.col("error_count") == 0)
    staged = list_stage(spark, landing).select(F.col("path").alias("filename")).distinct()
    return (h.join(staged, F.col("filename") == F.concat("stage_location", "file_name"), "inner")
            .select("filename", "file_name", "stage_location", "row_count"))


def purge(candidates: DataFrame) -> int:
    """Remove the files of ``purge_candidates`` from the stage; returns how many were there to remove.

    The paths are streamed one partition at a time; the window of the candidates bounds their number.
    """
    from spokewise.sources.fsio import delete_file
    spark = candidates.sparkSession
    return sum(delete_file(spark, r.filename) for r in candidates.select("filename").toLocalIterator())


def purge_after(batches: int, spark: SparkSession, raw_path: str, table_name: str, landing: str, now,
                hours: int = 10) -> int:
    """The step that depends on a consumer (T-9): purge when the consumer ran ``batches`` > 0 batches."""
    return purge(purge_candidates(spark, raw_path, table_name, landing, now, hours)) if batches else 0


def run_history(spark: SparkSession, state_root: str) -> DataFrame:
    """``task_history()``: executed runs plus the next scheduled run of each task."""
    cols = [f.name for f in RUN_LOG_SCHEMA.fields]
    parts = [read_run_log(spark, p).select(*cols)
             for p in (run_log_path(state_root), next_run_path(state_root)) if has_data_files(spark, p)]
    if not parts:
        return spark.createDataFrame([], RUN_LOG_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def recent_runs(history: DataFrame, now, minutes: int = 5) -> DataFrame:
    """Runs of the last ``minutes`` that are not merely scheduled, latest first (T-14, T13)."""
    return (history.where((F.col("scheduled_time") > dateadd("minute", -minutes, _ts(now)))
                          & (F.col("state") != F.lit("SCHEDULED")))
            .orderBy(F.col("completed_time").desc_nulls_first()))


def next_runs(history: DataFrame, now) -> DataFrame:
    """``timestampdiff(second, now, scheduled_time) next_run`` of scheduled runs (T-15)."""
    return (history.where(F.col("state") == F.lit("SCHEDULED"))
            .select(seconds_until(_ts(now), F.col("scheduled_time")).alias("next_run"),
                    "scheduled_time", "name", "state"))


def overview(spark: SparkSession, *, now, state_root: str, landing: str, raw_path: str,
             raw_table_name: str, stream_consumer: Consumer, bike_trips: DataFrame,
             bike_stations: DataFrame, trips: DataFrame) -> DataFrame:
    """Nine pipeline metrics in one row (J4, T-16).

    Each metric is a one-row aggregate over its own source; the nine
    rows are merged by ``one_row`` with a union and a global aggregate.
    """
    metrics = [
        next_runs(run_history(spark, state_root), now).agg(F.min("next_run").alias("time_to_next_pulse")),
        list_stage(spark, landing).agg(F.count_distinct("path").alias("files_in_bucket")),
        pending_files(spark, landing, raw_path).agg(F.count(F.lit(1)).alias("pending_file_count")),
        load_history(spark, raw_path, raw_table_name, now).agg(F.count(F.lit(1)).alias("files_processed")),
        read_raw(spark, raw_path).agg(F.count(F.lit(1)).alias("trips_raw")),
        peek(spark, stream_consumer, raw_path).agg(F.count(F.lit(1)).alias("recs_in_stream")),
        bike_trips.agg(F.count(F.lit(1)).alias("bike_trips")),
        bike_stations.agg(F.count(F.lit(1)).alias("bike_stations")),
        trips.agg(F.max("starttime").alias("max_date")),
    ]
    return one_row(metrics)


def one_row(metrics: list[DataFrame]) -> DataFrame:
    """Put single-row, single-column aggregates side by side without a join.

    Each aggregate is widened to all columns (NULL elsewhere), the rows are
    unioned and one global aggregate keeps the non-NULL value per column.
    """
    fields = [m.schema.fields[0] for m in metrics]
    wide = None
    for i, m in enumerate(metrics):
        row = m.select(*[(F.col(f.name) if j == i else F.lit(None).cast(f.dataType)).alias(f.name)
                         for j, f in enumerate(fields)])
        wide = row if wide is None else wide.unionByName(row)
    return wide.agg(*[F.max(f.name).alias(f.name) for f in fields])


__all__ = ["RAW_JSON_SCHEMA", "load_history", "next_runs", "overview", "peek", "pending_files",
           "purge", "purge_after", "purge_candidates", "recent_runs", "run_history"]
