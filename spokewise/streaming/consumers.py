"""Change streams on the raw table and the two tasks that consume them (T-3 ... T-9).

A change stream is a Structured Streaming Parquet source over the raw
sink folder; each consumer has its own checkpoint, so each sees every
committed raw row once, independently of the other (T-4). A trigger
with no new files runs no batch, which is the has-data gate (T-6).

``foreachBatch`` is at-least-once, so every write inside a batch
overwrites the partition ``batch_id=N`` (dynamic partition overwrite):
replaying batch N after a failure rewrites the same output instead of
appending it twice. The station merge only reads target partitions
``< N``, so a replay sees the same target as the first attempt.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from spokewise import schemas
from spokewise.operators.merge import STATION_COLS, merge_insert_only, stations_union
from spokewise.operators.semistructured import trip_fields, v_double, v_int, v_string
from spokewise.sources import fsio
from spokewise.sources.tables import has_data_files
from spokewise.streaming.ingest import DEFAULT_TRIGGER, RAW_JSON_SCHEMA, failed_files, truncated_commit

Handler = Callable[[DataFrame, int], None]


@dataclass
class Clock:
    """Times written to the run log. ``fixed`` pins them for deterministic runs."""

    fixed: _dt.datetime | None = None
    step: _dt.timedelta = field(default_factory=lambda: _dt.timedelta(seconds=1))
    _n: int = 0

    def now(self) -> _dt.datetime:
        if self.fixed is None:
            return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        self._n += 1
        return self.fixed + self.step * self._n


@dataclass
class Consumer:
    name: str
    state_root: str

    @property
    def checkpoint(self) -> str:
        return f"{self.state_root}/consumers/{self.name}/_checkpoint"

    @property
    def files_log(self) -> str:
        return f"{self.state_root}/consumers/{self.name}/files"


RAW_FILE = "_raw_file"

RUN_LOG_SCHEMA = StructType(list(schemas.RUN_LOG.fields) + [StructField("run", LongType(), True),
                                                             StructField("rows_in", LongType(), True)])


def _run_row(name, batch_id, scheduled, completed, state, rows, run) -> str:
    def t(x):
        return None if x is None else x.isoformat(sep=" ")
    return json.dumps({"name": name, "batch_id": batch_id, "scheduled_time": t(scheduled),
                       "completed_time": t(completed), "state": state,
                       "rows": None if rows is None else int(rows), "run": run,
                       "rows_in": None if rows is None else int(rows)})


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Run-log files (JSON, one row each) as a DataFrame."""
    return spark.read.schema(RUN_LOG_SCHEMA).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]") \
        .json(path)


def run_log_path(state_root: str) -> str:
    return f"{state_root}/runlog"


def next_run_path(state_root: str) -> str:
    return f"{state_root}/runnext"


def _overwrite_partition(df: DataFrame, path: str, batch_id: int) -> None:
    (df.withColumn("batch_id", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))


def change_stream(spark: SparkSession, raw_path: str, raw_schema: StructType = RAW_JSON_SCHEMA,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """``create stream s on table raw``: committed raw rows, good ones only.

    ``max_files_per_trigger`` bounds a micro-batch, so a consumer that starts
    behind a large raw table catches up in bounded batches. ``RAW_FILE`` names
    the raw file of each row.
    """
    r = spark.readStream.schema(raw_schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    s = r.parquet(raw_path).withColumn(RAW_FILE, F.col("_metadata.file_path"))
    return s.where((F.col("_ok") == F.lit("true")) & (F.col("_commit") > truncated_commit(spark, raw_path)))


def start_consumer(spark: SparkSession, consumer: Consumer, raw_path: str, handler: Handler,
                   clock: Clock | None = None, run: int = 0, available_now: bool = True,
                   trigger: str = DEFAULT_TRIGGER, interval: _dt.timedelta = _dt.timedelta(minutes=1),
                   raw_schema: StructType = RAW_JSON_SCHEMA, max_files_per_trigger: int | None = None,
                   skip_failed_files: bool = True):
    """Start one consumer; returns ``(query, batches)`` where ``batches`` fills as batches run.

    Per batch: the handler writes its output partition, then the files the
    batch consumed are logged (for peeking) and a run-log row is written.

    A pipe skips files with errors (T18): a source file with any rejected row contributes
    no rows, unless ``skip_failed_files`` is off. The verdict on a file is committed with its
    rows, so it is known to every batch that has some of them, bounded or not.
    """
    clock = clock or Clock()
    state = consumer.state_root
    batches: list[int] = []

    def process(df: DataFrame, batch_id: int) -> None:
        scheduled = clock.now()
        rows = df.join(failed_files(spark, raw_path), "_file", "left_anti") if skip_failed_files else df
        handler(rows.drop(RAW_FILE), batch_id)
        # every file read by the batch is consumed, also a skipped one; a landing file may be spread
        # over several raw files, of which a bounded batch takes some
        files = df.groupBy("_file", RAW_FILE).agg(F.count(F.lit(1)).alias("rows"))
        _overwrite_partition(files, consumer.files_log, batch_id)
        logged = f"{consumer.files_log}/batch_id={batch_id}"   # absent where the batch has rejected rows only
        rows_in = spark.read.parquet(logged).agg(F.sum("rows")).first()[0] if fsio.exists(spark, logged) else 0
        done = clock.now()
        # one small file per (task, batch), overwritten on replay: idempotent
        fsio.write_text(spark, f"{run_log_path(state)}/{consumer.name}-{batch_id:012d}.json",
                        _run_row(consumer.name, batch_id, scheduled, done, "SUCCEEDED", rows_in, run),
                        overwrite=True)
        fsio.write_text(spark, f"{next_run_path(state)}/{consumer.name}.json",
                        _run_row(consumer.name, batch_id, scheduled + interval, None, "SCHEDULED", None, run),
                        overwrite=True)
        batches.append(batch_id)

    w = (change_stream(spark, raw_path, raw_schema, max_files_per_trigger).writeStream
         .queryName(f"{consumer.name}_{run}")
         .foreachBatch(process).option("checkpointLocation", consumer.checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start(), batches


def await_all(*started) -> list[int]:
    """Wait for ``availableNow`` consumers started together; returns batches run by each."""
    out = []
    for q, batches in started:
        q.awaitTermination()
        if q.exception():
            raise q.exception()
        out.append(len(batches))
    return out


def run_consumer(spark: SparkSession, consumer: Consumer, raw_path: str, handler: Handler,
                 **kw) -> int:
    """Run one consumer over everything committed now; returns the number of micro-batches."""
    kw.setdefault("available_now", True)
    q, batches = start_consumer(spark, consumer, raw_path, handler, **kw)
    if not kw["available_now"]:
        return 0
    return await_all((q, batches))[0]


# ------------------------------------------------------------------ the two tasks

def push_trips_handler(bike_trips_path: str) -> Handler:
    """Task ``push_trips``: typed trip columns out of each new document (T-7)."""
    def handle(df: DataFrame, batch_id: int) -> None:
        _overwrite_partition(trip_fields(df), bike_trips_path, batch_id)
    return handle


def station_fields(df: DataFrame, v: str = "v") -> DataFrame:
    cols = []
    for p in ("start", "end"):
        cols += [v_int(v, f"{p}_station_id").alias(f"{p}_station_id"),
                 v_string(v, f"{p}_station_name").alias(f"{p}_station_name"),
                 v_double(v, f"{p}_station_latitude").alias(f"{p}_station_latitude"),
                 v_double(v, f"{p}_station_longitude").alias(f"{p}_station_longitude")]
    return df.select(*cols)


def read_batches(spark: SparkSession, path: str, schema: StructType, before: int | None = None) -> DataFrame:
    """A table written as ``batch_id=N`` partitions; ``before`` keeps partitions < N (pruned)."""
    full = StructType(list(schema.fields) + [StructField("batch_id", LongType(), True)])
    if not has_data_files(spark, path):
        return spark.createDataFrame([], full)
    df = spark.read.schema(full).parquet(path)
    return df if before is None else df.where(F.col("batch_id") < F.lit(before))


def push_stations_handler(spark: SparkSession, bike_stations_path: str) -> Handler:
    """Task ``push_stations``: union of both stations per trip, insert the unmatched (T-8)."""
    def handle(df: DataFrame, batch_id: int) -> None:
        target = read_batches(spark, bike_stations_path, schemas.BIKE_STATIONS, before=batch_id)
        new = merge_insert_only(target, stations_union(station_fields(df)))
        _overwrite_partition(new.select(*STATION_COLS), bike_stations_path, batch_id)
    return handle
