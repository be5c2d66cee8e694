"""Bulk loads from a stage into a table.

``copy_into`` reproduces the dialect's COPY semantics on Spark:

* the stage is listed once (metadata only), filtered by a full-match
  regex (``pattern``), and the listing is written;
* files whose rows the table holds are skipped (load-once). The loads that
  count travel with the table's versions: restoring an earlier version,
  re-creating or truncating the table (T17) makes later loads pending again;
* the files are parsed **once**, in batches of at most ``FILES_PER_BATCH``, with an all-STRING schema, PERMISSIVE
  mode and a corrupt-record column; each token is ``try_cast`` to its
  column type and a row is rejected when a non-NULL token does not cast
  or the column count is wrong under a strict format;
* the parsed rows are written once into a staging segment partitioned
  by ``_ok``: ``_ok=true`` becomes table data, ``_ok=false`` the reject
  table, with no second parse;
* a per-file ledger (rows parsed / loaded, errors, first error, status)
  is aggregated from the staged Parquet into a ledger segment that is
  committed in the *same* table version as the data, so a file is marked
  loaded exactly when its rows become visible;
* ``on_error``: ``abort`` commits nothing when any row failed,
  ``continue`` commits the good rows, ``skip_file`` drops every row of a
  file that has an error (T18).

A failed job commits nothing: the version log is written only after the
Spark write job succeeded, so a lost executor can at most leave an
unreferenced staging folder behind.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType, TimestampNTZType

from spokewise import schemas
from spokewise.functions._util import ntz_lit, utc_now
from spokewise.operators.masking import MaskPolicy, apply_masks, current_role, policies_of_text, policies_to_text
from spokewise.session import new_workdir
from spokewise.sources import fsio, records
from spokewise.sources.formats import CsvFormat
from spokewise.sources.stage import list_stage, literal_paths, path_batches, plain_path
from spokewise.sources.tables import VersionedTable, has_data_files

CORRUPT = "_corrupt_record"
RAW = "_raw_"
FILES_PER_BATCH = 10_000  # files that one parse job of a load reads; bounds the driver's path list
ON_ERROR = ("abort", "continue", "skip_file")
LOADED, PARTIAL, FAILED = "LOADED", "PARTIALLY_LOADED", "LOAD_FAILED"


class LoadError(RuntimeError):
    pass


# ------------------------------------------------------------------ catalog

class Catalog:
    """A folder of named versioned tables; each table carries its own load ledger."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._tables: dict[str, VersionedTable] = {}

    def table(self, name: str) -> VersionedTable:
        if name not in self._tables:
            self._tables[name] = VersionedTable(self.spark, f"{self.root}/{name}", name)
        return self._tables[name]

    def table_names(self) -> list[str]:
        fs, p = fsio._fs(self.spark, self.root)
        if not fs.exists(p):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()
                      and fsio.exists(self.spark, f"{self.root}/{s.getPath().getName()}/_log"))

    def set_masks(self, name: str, policies: dict[str, MaskPolicy]) -> None:
        """``alter table T modify column c set masking policy p`` for each column; an empty dict unsets all.

        The binding is kept beside the table and holds for every version of it.
        """
        columns = {f.name: f.dataType.simpleString() for f in self.table(name).schema().fields}
        for c, p in policies.items():
            if columns.get(c) != p.type_name:
                raise ValueError(f"policy {p.name} is for {p.type_name}; {name}.{c} is {columns.get(c, 'no column')}")
        fsio.write_text(self.spark, f"{self.root}/{name}/_masks.json", policies_to_text(policies), overwrite=True)

    def masks(self, name: str) -> dict[str, MaskPolicy]:
        path = f"{self.root}/{name}/_masks.json"
        return policies_of_text(fsio.read_text(self.spark, path)) if fsio.exists(self.spark, path) else {}

    def read(self, name: str, version: int | None = None, role: str | None = None) -> DataFrame:
        """The table as the session's role (or ``role``) sees it: bound columns are masked at the scan, so
        no filter, join or aggregate above it sees a raw value."""
        df = self.table(name).read(version)
        bound = {c: p for c, p in self.masks(name).items() if c in df.columns}
        return apply_masks(df, bound, role or current_role(self.spark)) if bound else df

    def ledger_of(self, table: VersionedTable, live: bool = False) -> DataFrame:
        """Ledger rows of all loads, or (``live``) of the loads whose rows the table holds now."""
        return read_ledger(table, table.loaded_segments() if live else table.ledger_segments())

    def load_history(self, table_name: str | None = None, start_time=None) -> DataFrame:
        """``copy_history(table_name, start_time)`` (S12, T-13); all tables when no name."""
        names = [table_name] if table_name is not None else self.table_names()
        parts = [self.ledger_of(self.table(n)) for n in names]
        h = parts[0] if parts else self.spark.createDataFrame([], STORED_LEDGER)
        for p in parts[1:]:
            h = h.unionByName(p)
        if start_time is not None:
            h = h.where(F.col("last_load_time") >= ntz_lit(start_time))
        return h.drop("share")


LEDGER_SCHEMA = StructType(list(schemas.LOAD_LEDGER.fields) + [
    StructField("generation", schemas.L, True), StructField("file_path", StringType(), True)])
#: As written: a folder for each share of the paths, so that a lookup of files reads the shares they fall in.
STORED_LEDGER = StructType([*LEDGER_SCHEMA.fields, StructField("share", IntegerType())])
SHARES = 64
MERGE_RUNS = 16   # ledger segments that a load may find before it merges them into one


def share_of(path: Column) -> Column:
    """Share of the ledger that a file's row is in."""
    return F.pmod(F.xxhash64(path), F.lit(SHARES)).cast("int")


def new_ledger_path(table: VersionedTable) -> str:
    return f"{table.root}/ledger/run={uuid.uuid4().hex}"


def read_ledger(table: VersionedTable, paths: list[str]) -> DataFrame:
    if not paths:
        return table.spark.createDataFrame([], STORED_LEDGER)
    return (table.spark.read.schema(STORED_LEDGER).option("basePath", f"{table.root}/ledger").parquet(*paths)
            .select(*STORED_LEDGER.fieldNames()))


def write_ledger(rows: DataFrame, path: str) -> None:
    """Ledger rows by share, each share one sorted file."""
    (rows.select(*LEDGER_SCHEMA.fieldNames(), share_of(F.col("file_path")).alias("share"))
     .repartition("share").sortWithinPartitions("share", "file_path").write.partitionBy("share").parquet(path))


@dataclass
class LoadReport:
    files: int
    rows_loaded: int
    rows_rejected: int
    status: str


# ------------------------------------------------------------------ parsing

AUTO = "AUTO"
#: The formats that AUTO knows, in order of preference, beside ISO text and numbers since the epoch.
ISO, EPOCH = "ISO", "EPOCH"
AUTO_FORMATS = (ISO, "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm", "MM/dd/yyyy", "dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm",
                "dd/MM/yyyy", "dd-MMM-yyyy HH:mm:ss", "dd-MMM-yyyy", EPOCH)
#: From these on a number counts milli-, micro- and nanoseconds.
EPOCH_STEPS = (31_536_000_000, 31_536_000_000_000, 31_536_000_000_000_000)


def _epoch(tok: Column) -> Column:
    """A whole number as the time since 1970, its unit told by its size; null for other text."""
    n = F.when(tok.rlike("^-?[0-9]{1,18}$"), tok.try_cast("long"))
    micros = F.floor(n / 1000).cast("long")     # nanoseconds
    for limit, factor in zip(reversed(EPOCH_STEPS), (1, 1_000, 1_000_000), strict=True):
        micros = F.when(F.abs(n) < limit, n * factor).otherwise(micros)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=(micros / 1_000_000).cast("decimal(18,6)"))


def _read_as(tok: Column, fmt: str) -> Column:
    """The token under one of ``AUTO_FORMATS``; null where it does not fit."""
    if fmt == ISO:      # starts with a year and a month
        return F.when(tok.rlike("^\\s*[0-9]{4}-[0-9]{1,2}"), tok.try_cast("timestamp_ntz"))
    if fmt == EPOCH:
        return _epoch(tok)
    return F.when(tok.rlike(_shape(fmt)), F.try_to_timestamp(tok, F.lit(fmt))).cast("timestamp_ntz")


def _shape(fmt: str) -> str:
    """A regex for text of the format, so that hardly any other text meets the (slow to fail) parser."""
    parts = {"yyyy": "[0-9]{4}", "MMM": "[A-Z][a-z]{2}", "MM": "(0[1-9]|1[0-2])", "dd": "(0[1-9]|[12][0-9]|3[01])",
             "HH": "([01][0-9]|2[0-3])", "mm": "[0-5][0-9]", "ss": "[0-5][0-9]"}
    return "^" + re.sub(r"[A-Za-z]+", lambda m: parts[m[0]], fmt) + "$"


def infer_formats(tokens: DataFrame, columns: list[str]) -> DataFrame:
    """One row: for each column the number of its tokens that fit each of ``AUTO_FORMATS`` (an array)."""
    return tokens.agg(*[F.array(*[F.count(_read_as(F.col(c), f)) for f in AUTO_FORMATS]).alias(c) for c in columns])


def auto_formats(spark: SparkSession, batches, schema: StructType, fmt: CsvFormat) -> dict[str, str]:
    """The format of each date and time column: the one that most tokens of all files fit, the first of equals.

    One scan of the files, a short row per batch of files.
    """
    columns = [f.name for f in schema.fields if isinstance(f.dataType, (TimestampNTZType, DateType))]
    if AUTO not in fmt.timestamp_formats or not columns:
        return {}
    plain = replace(fmt, timestamp_formats=())
    fits = {c: [0] * len(AUTO_FORMATS) for c in columns}
    for paths in batches:
        row = infer_formats(parse_csv(spark, paths, schemas.all_string(schema), plain), columns).first()
        fits = {c: [a + b for a, b in zip(fits[c], row[c], strict=True)] for c in columns}
    return {c: AUTO_FORMATS[max(range(len(n)), key=lambda k: (n[k], -k))] for c, n in fits.items()}


def _typed(tok: Column, dtype, timestamp_formats: tuple[str, ...] = ()) -> Column:
    if isinstance(dtype, (TimestampNTZType, DateType)) and len(timestamp_formats) == 1 and timestamp_formats[0] in AUTO_FORMATS:
        return _read_as(tok, timestamp_formats[0]).cast(dtype)
    if isinstance(dtype, TimestampNTZType):
        # ISO text first ("AUTO"), then each listed pattern
        alts = [tok.try_cast("timestamp_ntz")]
        alts += [F.try_to_timestamp(tok, F.lit(fmt)).cast("timestamp_ntz") for fmt in timestamp_formats]
        return F.coalesce(*alts) if len(alts) > 1 else alts[0]
    return tok.try_cast(dtype)


def validate(raw: DataFrame, schema: StructType, strict_columns: bool,
             null_tokens: tuple[str, ...] = (), timestamp_formats: tuple[str, ...] = (),
             file_col: str = "_metadata.file_path", broken: Column | None = None,
             found: dict[str, str] | None = None) -> DataFrame:
    """Typed columns plus ``_ok``/``_error`` from an all-STRING parse.

    ``broken`` marks rows that are rejected whatever their tokens are; ``found`` has the
    formats of columns as ``auto_formats`` tells them.

    An empty unquoted field already arrives as NULL and is not an error;
    a non-NULL token that does not cast is.
    """
    if null_tokens:
        raw = raw.select(*[F.when(F.col(c).isin(*null_tokens), F.lit(None)).otherwise(F.col(c)).alias(c)
                           if c in schema.fieldNames() else F.col(c) for c in raw.columns],
                         *(["_metadata"] if file_col.startswith("_metadata") else []))
    typed, errs = [], []
    if broken is not None:
        errs.append(F.when(broken, F.lit("record too long")))
    if strict_columns:
        errs.append(F.when(F.col(CORRUPT).isNotNull(), F.lit("column count mismatch")))
    for f in schema.fields:
        tok = F.col(f.name)
        t = _typed(tok, f.dataType, (found[f.name],) if found and f.name in found else timestamp_formats)
        typed.append(t.alias(f.name))
        errs.append(F.when(tok.isNotNull() & t.isNull(),
                           F.concat(F.lit(f"cannot convert '{f.name}': "), tok)))
    err = F.coalesce(*errs)
    out = raw.select(*typed, err.alias("_error"),
                     *[F.col(f.name).alias(RAW + f.name) for f in schema.fields],
                     plain_path(file_col).alias("_file"))
    return out.select(*[F.col(f.name) for f in schema.fields], "_error",
                      *[F.when(F.col("_error").isNotNull(), F.col(RAW + f.name)).alias(RAW + f.name)
                        for f in schema.fields],
                      "_file", F.col("_error").isNull().alias("_ok"))


def parse_csv(spark: SparkSession, paths: list[str], schema: StructType, fmt: CsvFormat,
              found: dict[str, str] | None = None) -> DataFrame:
    """Validated rows of the files; those with records that span lines or with escapes go through ``records``."""
    if not records.needs_states(fmt):
        return _parse_plain(spark, paths, schema, fmt, found)
    spanning = records.open_files(records.read_lines(spark, literal_paths(paths), fmt), fmt)
    odd = {r.file for r in spanning.select(plain_path("file").alias("file")).collect()}   # of one batch of files
    plain = [p for p in paths if p not in odd]
    parts = [_parse_plain(spark, plain, schema, fmt, found)] if plain or not odd else []
    parts += [_parse_records(spark, sorted(odd), schema, fmt, found)] if odd else []
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _parse_records(spark: SparkSession, paths: list[str], schema: StructType, fmt: CsvFormat,
                   found: dict[str, str] | None) -> DataFrame:
    lines = records.numbered(records.read_lines(spark, literal_paths(paths), fmt), fmt,
                             lambda df: _written(df, "records"))
    rows = records.gathered(lines, fmt).withColumn("_fields", records.fields_of(F.col("record"), fmt))
    wrong = F.when(F.size("_fields") != len(schema.fields), F.col("record"))
    raw = rows.select(*[F.get("_fields", F.lit(i)).alias(f.name) for i, f in enumerate(schema.fields)],
                      wrong.alias(CORRUPT), F.col("file").alias("_path"), F.col("too_long").alias("_too_long"))
    return validate(raw, schema, fmt.error_on_column_count_mismatch, tuple(n for n in fmt.null_if if n),
                    fmt.timestamp_formats, "_path", F.col("_too_long"), found)


def _parse_plain(spark: SparkSession, paths: list[str], schema: StructType, fmt: CsvFormat,
                 found: dict[str, str] | None) -> DataFrame:
    read_schema = StructType(list(schemas.all_string(schema).fields) + [StructField(CORRUPT, StringType())])
    raw = (spark.read.schema(read_schema).options(**fmt.reader_options())
           .option("columnNameOfCorruptRecord", CORRUPT).csv(literal_paths(paths)))
    return validate(raw, schema, fmt.error_on_column_count_mismatch, fmt.extra_null_tokens(),
                    fmt.timestamp_formats, found=found)


def parse_json_variant(spark: SparkSession, paths: list[str]) -> DataFrame:
    """JSON lines into one VARIANT column ``v`` (S8); a malformed line is a reject."""
    raw = spark.read.format("json").option("singleVariantColumn", "v").load(literal_paths(paths))
    ok = F.col("v").isNotNull()
    return raw.select("v", F.when(~ok, F.lit("malformed JSON")).alias("_error"),
                      plain_path("_metadata.file_path").alias("_file"), ok.alias("_ok"))


# ------------------------------------------------------------------ loading

def pending_listing(cat: Catalog, table: VersionedTable, stage: str, pattern: str | None,
                    force: bool = False) -> DataFrame:
    """Stage files whose rows the table does not hold yet (S13, T-12), as a written table.

    The stage is listed once. Only the shares of the ledger that the listed files
    fall in are read.
    """
    spark = cat.spark
    listing = list_stage(spark, stage, pattern).withColumn("share", share_of(F.col("path")))
    listing = _written(listing, "listing")
    if force or not table.loaded_segments():
        return listing.drop("share")
    shares = [r.share for r in listing.select("share").distinct().collect()]   # at most SHARES
    done = (cat.ledger_of(table, live=True)
            .where(F.col("share").isin(shares) & F.col("status").isin(LOADED, PARTIAL))
            .select(F.col("file_path").alias("path"), "share"))
    return listing.join(done, ["share", "path"], "left_anti").drop("share")


def _written(df: DataFrame, tag: str) -> DataFrame:
    path = new_workdir(df.sparkSession, tag) + "/data"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merge_ledger(cat: Catalog, table: VersionedTable) -> list[str]:
    """Segments of the live ledger rows, merged into one run once there are more than ``MERGE_RUNS``.

    The merged run counts from the next commit on; earlier versions keep their segments.
    """
    segments = table.loaded_segments()
    if len(segments) <= MERGE_RUNS:
        return segments
    run = new_ledger_path(table)
    write_ledger(cat.ledger_of(table, live=True), run)
    return [run]


def copy_into(cat: Catalog, table_name: str, stage: str, schema: StructType | None,
              fmt: CsvFormat | str, on_error: str = "abort", pattern: str | None = None,
              force: bool = False, now=None, rejects_table: str | None = None) -> LoadReport:
    """``copy into T from @stage file_format=F [on_error=...] [pattern=...]``."""
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}")
    spark = cat.spark
    table = cat.table(table_name)
    is_json = fmt == "json"
    if not table.log():
        if is_json:
            raise LookupError(f"create table {table_name} (v variant) first")
        table.create_empty(schema)
    if schema is None:
        schema = table.schema()
    # Files are parsed in bounded batches; nothing is visible before the one commit at the end.
    staged_segments, ledgers = [], []
    pending = pending_listing(cat, table, stage, pattern, force)
    found = {} if is_json else auto_formats(spark, path_batches(pending, FILES_PER_BATCH), schema, fmt)
    for paths in path_batches(pending, FILES_PER_BATCH):
        seg, ledger_seg = _stage_files(cat, table, table_name, paths, schema, fmt, on_error, now, found)
        staged_segments.append(seg)
        ledgers.append(ledger_seg)
    if not ledgers:
        return LoadReport(0, 0, 0, "NO_NEW_FILES")
    ledger = read_ledger(table, ledgers)
    totals = ledger.agg(F.count(F.lit(1)).alias("files"), F.sum("row_parsed").alias("parsed"),
                        F.sum("error_count").alias("bad"), F.min("first_error").alias("err")).first()
    n_files, bad = totals["files"], totals["bad"] or 0
    good = (totals["parsed"] or 0) - bad

    commit_segments = [f"{seg}/_ok=true" for seg in staged_segments]
    if on_error == "abort" and bad:
        commit_segments = []
    elif on_error == "skip_file" and bad:
        failed = ledger.where(F.col("error_count") > 0).select(F.col("file_path").alias("_file"))
        held = [p for p in commit_segments if has_data_files(spark, p)]
        columns = StructType([*schema.fields, StructField("_file", StringType())])
        rows = spark.read.schema(columns).parquet(*held) if held else spark.createDataFrame([], columns)
        new_seg = table.new_segment_path()
        rows.join(failed, "_file", "left_anti").write.parquet(new_seg)
        commit_segments = [new_seg]
        good = ledger.agg(F.sum("row_count")).first()[0] or 0

    # one commit publishes the rows and marks their files loaded; an aborted
    # load commits only its ledger rows (status LOAD_FAILED), no data
    text = f"copy into {table_name} from {stage}"
    table.append_segments(commit_segments, text, now, ledger=ledgers, loaded=merge_ledger(cat, table) + ledgers,
                          op="copy" if commit_segments else "copy failed")

    if rejects_table:
        rt = cat.table(rejects_table)
        if not rt.log():
            rt.create_empty(reject_schema(schema, is_json))
        rt.append_segments([f"{seg}/_ok=false" for seg in staged_segments],
                           f"rejects of copy into {table_name}", now)

    if on_error == "abort" and bad:
        raise LoadError(f"copy into {table_name} aborted: {bad} rejected rows; first error: {totals['err']}")
    return LoadReport(n_files, int(good), int(bad), "LOADED" if not bad else on_error.upper())


def _stage_files(cat: Catalog, table: VersionedTable, table_name: str, paths: list[str], schema: StructType,
                 fmt: CsvFormat | str, on_error: str, now, found: dict[str, str]) -> tuple[str, str]:
    """Parse one batch of files into a staged segment and write its ledger segment; returns both paths."""
    spark = cat.spark
    parsed = parse_json_variant(spark, paths) if fmt == "json" else parse_csv(spark, paths, schema, fmt, found)
    seg = table.new_segment_path()
    parsed.write.partitionBy("_ok").parquet(seg)
    # the schema is given, so a batch without any row reads as empty; partition values come back as text
    staged_schema = StructType([f for f in parsed.schema.fields if f.name != "_ok"]
                               + [StructField("_ok", StringType())])
    staged = spark.read.schema(staged_schema).parquet(seg).withColumn("_ok", F.col("_ok") == F.lit("true"))

    if on_error == "continue":
        status = F.when(F.col("error_count") == 0, LOADED).otherwise(PARTIAL)
        loaded = F.col("row_count")
    else:
        status = F.when(F.col("error_count") == 0, LOADED).otherwise(FAILED)
        loaded = F.when(F.col("error_count") == 0, F.col("row_count")).otherwise(F.lit(0))

    # One pass over the staged rows: a partial + final aggregate by file. Every file of the batch
    # gets a ledger row, also one without rows (header only, empty).
    counts = staged.groupBy("_file").agg(
        F.count(F.lit(1)).alias("row_parsed"), F.sum(F.col("_ok").cast("long")).alias("row_count"),
        F.sum((~F.col("_ok")).cast("long")).alias("error_count"), F.min("_error").alias("first_error"))
    files = spark.createDataFrame([(p,) for p in paths], "_file string")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("row_parsed", "row_count", "error_count")]
    ledger_rows = (files.join(counts, "_file", "left").select("_file", *zero, "first_error")
                   .select(F.lit(table_name).alias("table_name"),
                           F.regexp_extract("_file", r"^(.*/)[^/]*$", 1).alias("stage_location"),
                           F.regexp_extract("_file", r"([^/]*)$", 1).alias("file_name"),
                           (ntz_lit(now) if now is not None else utc_now()).alias("last_load_time"),
                           "row_parsed", loaded.cast("long").alias("row_count"), "error_count",
                           "first_error", status.alias("status"),
                           F.lit(table.current().generation).cast("long").alias("generation"),
                           F.col("_file").alias("file_path")))
    ledger_seg = new_ledger_path(table)
    write_ledger(ledger_rows, ledger_seg)
    return seg, ledger_seg


def reject_schema(schema: StructType, is_json: bool) -> StructType:
    if is_json:
        return StructType([StructField("_file", StringType()), StructField("_error", StringType())])
    return StructType([StructField("_file", StringType()), StructField("_error", StringType())]
                      + [StructField(RAW + f.name, StringType()) for f in schema.fields])


def truncate(cat: Catalog, table_name: str, now=None):
    """``truncate table`` (S19): empties the table and forgets its loaded files."""
    return cat.table(table_name).truncate(now=now)
