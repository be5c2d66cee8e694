"""Bulk load semantics on the edge rows of FIXTURES.md §4."""

import gzip
import os

import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampNTZType

from spokewise.sources import loader
from spokewise.sources.formats import FORMAT_A, FORMAT_B, CsvFormat
from spokewise.sources.stage import list_stage

SCHEMA = StructType([StructField("id", IntegerType()), StructField("name", StringType()),
                     StructField("t", TimestampNTZType())])
TOLERANT = CsvFormat(quote='"', error_on_column_count_mismatch=False)
STRICT = CsvFormat(quote='"', error_on_column_count_mismatch=True)


def write(path, name, lines, gz=False):
    os.makedirs(path, exist_ok=True)
    data = ("\n".join(lines) + "\n").encode()
    full = os.path.join(path, name)
    if gz:
        with gzip.open(full, "wb") as f:
            f.write(data)
    else:
        with open(full, "wb") as f:
            f.write(data)
    return full


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_tolerant_mismatch_fills_and_cuts(spark, workdir):
    stage = f"{workdir}/stage"
    write(stage, "a.csv", ["1,a,2018-01-01 00:00:00", "2,b", "3,c,2018-01-02 00:00:00,extra", "5,,"])
    cat = loader.Catalog(spark, f"{workdir}/db")
    rep = loader.copy_into(cat, "t", stage, SCHEMA, TOLERANT, on_error="continue")
    got = rows(cat.table("t").read())
    assert rep.rows_loaded == 4 and rep.rows_rejected == 0
    import datetime as dt
    assert got == [(1, "a", dt.datetime(2018, 1, 1)), (2, "b", None), (3, "c", dt.datetime(2018, 1, 2)),
                   (5, None, None)]


def test_strict_mismatch_rejects(spark, workdir):
    stage = f"{workdir}/stage"
    write(stage, "a.csv", ["1,a,2018-01-01 00:00:00", "2,b", "3,c,2018-01-02 00:00:00,extra", "5,,"])
    cat = loader.Catalog(spark, f"{workdir}/db")
    rep = loader.copy_into(cat, "t", stage, SCHEMA, STRICT, on_error="continue", rejects_table="rj")
    assert rep.rows_loaded == 2 and rep.rows_rejected == 2
    errs = {r["_error"] for r in cat.table("rj").read().collect()}
    assert errs == {"column count mismatch"}


def test_bad_number_continue_and_abort(spark, workdir):
    stage = f"{workdir}/stage"
    write(stage, "a.csv", ["1,a,2018-01-01 00:00:00", "bad,d,2018-01-03 00:00:00", '4,"x,y",'])
    cat = loader.Catalog(spark, f"{workdir}/db")
    with pytest.raises(loader.LoadError):
        loader.copy_into(cat, "t", stage, SCHEMA, STRICT, on_error="abort")
    assert cat.table("t").read().count() == 0
    rep = loader.copy_into(cat, "t", stage, SCHEMA, STRICT, on_error="continue", rejects_table="rj")
    assert rep.rows_loaded == 2 and rep.rows_rejected == 1
    names = {r["name"] for r in cat.table("t").read().collect()}
    assert names == {"a", "x,y"}  # a quoted delimiter stays inside one field
    rj = cat.table("rj").read().first()
    assert rj["_raw_id"] == "bad" and "'id'" in rj["_error"]


def test_skip_file_drops_whole_file(spark, workdir):
    stage = f"{workdir}/stage"
    write(stage, "good.csv", ["1,a,", "2,b,"])
    write(stage, "bad.csv", ["3,c,", "x,d,"])
    cat = loader.Catalog(spark, f"{workdir}/db")
    loader.copy_into(cat, "t", stage, SCHEMA, STRICT, on_error="skip_file")
    assert sorted(r["id"] for r in cat.table("t").read().collect()) == [1, 2]
    st = {r["file_name"]: r["status"] for r in cat.load_history("t").collect()}
    assert st == {"good.csv": "LOADED", "bad.csv": "LOAD_FAILED"}


def test_pattern_excludes_json_and_gzip_is_read(spark, workdir):
    stage = f"{workdir}/stage"
    write(stage, "t1.csv.gz", ["id,name,t", "1,a,2018-01-01 00:00:00"], gz=True)
    write(stage, "w.json", ['{"a": 1}'])
    cat = loader.Catalog(spark, f"{workdir}/db")
    names = {r["name"] for r in list_stage(spark, stage, r".*[.]csv[.]gz").collect()}
    assert names == {"t1.csv.gz"}
    loader.copy_into(cat, "t", stage, SCHEMA, FORMAT_A, on_error="continue", pattern=r".*[.]csv[.]gz")
    assert rows(cat.table("t").read())[0][0] == 1


def test_load_once_and_truncate(spark, workdir):
    stage = f"{workdir}/stage"
    write(stage, "a.csv", ["1,a,", "2,b,"])
    cat = loader.Catalog(spark, f"{workdir}/db")
    loader.copy_into(cat, "t", stage, SCHEMA, FORMAT_B, on_error="abort")
    again = loader.copy_into(cat, "t", stage, SCHEMA, FORMAT_B, on_error="abort")
    assert again.files == 0 and cat.table("t").read().count() == 2
    loader.truncate(cat, "t")
    assert cat.table("t").read().count() == 0
    loader.copy_into(cat, "t", stage, SCHEMA, FORMAT_B, on_error="abort")
    assert cat.table("t").read().count() == 2
    # a new file is picked up, the old one is not loaded again
    write(stage, "b.csv", ["3,c,"])
    rep = loader.copy_into(cat, "t", stage, SCHEMA, FORMAT_B, on_error="abort")
    assert rep.files == 1 and cat.table("t").read().count() == 3


def test_good_plus_rejects_equals_input(spark, workdir):
    stage = f"{workdir}/stage"
    lines = [f"{i},n{i}," if i % 3 else f"z{i},n{i}," for i in range(60)]
    write(stage, "a.csv", lines)
    cat = loader.Catalog(spark, f"{workdir}/db")
    loader.copy_into(cat, "t", stage, SCHEMA, STRICT, on_error="continue", rejects_table="rj")
    assert cat.table("t").read().count() + cat.table("rj").read().count() == 60
    h = cat.load_history("t").first()
    assert (h["row_parsed"], h["row_count"], h["error_count"], h["status"]) == (60, 40, 20, "PARTIALLY_LOADED")


def test_json_variant_load_rejects_malformed(spark, workdir):
    from pyspark.sql.types import VariantType
    stage = f"{workdir}/stage"
    write(stage, "a.json", ['{"city": {"id": 1}}', "{bad", '{"city": {"id": 2}}'])
    cat = loader.Catalog(spark, f"{workdir}/db")
    cat.table("raw").create_empty(StructType([StructField("v", VariantType())]))
    rep = loader.copy_into(cat, "raw", stage, None, "json", on_error="continue")
    assert rep.rows_loaded == 2 and rep.rows_rejected == 1
    ids = sorted(r[0] for r in cat.table("raw").read().selectExpr("v:city.id::int").collect())
    assert ids == [1, 2]


def test_narrow_table_by_position(spark, workdir):
    stage = f"{workdir}/stage"
    write(stage, "a.csv", ["1,a,2018-01-01 00:00:00,x,y"])
    narrow = StructType(SCHEMA.fields[:2])
    cat = loader.Catalog(spark, f"{workdir}/db")
    loader.copy_into(cat, "t", stage, narrow, TOLERANT, on_error="continue")
    assert rows(cat.table("t").read()) == [(1, "a")]


def test_null_tokens_and_timestamp_formats(spark, workdir):
    stage = f"{workdir}/stage"
    write(stage, "a.csv", ["1,NULL,1/2/2018 13:05", "2,n/a,2018-01-03 00:00:00", "3,x,"])
    fmt = CsvFormat(null_if=("", "NULL", "n/a"), timestamp_formats=("M/d/yyyy H:mm",))
    cat = loader.Catalog(spark, f"{workdir}/db")
    rep = loader.copy_into(cat, "t", stage, SCHEMA, fmt, on_error="abort")
    import datetime as dt
    assert rep.rows_rejected == 0
    assert rows(cat.table("t").read()) == [(1, None, dt.datetime(2018, 1, 2, 13, 5)),
                                          (2, None, dt.datetime(2018, 1, 3)), (3, "x", None)]


def test_plain_csv_format_has_no_quotes(spark, workdir):
    from spokewise.sources.formats import FORMAT_C
    stage = f"{workdir}/stage"
    write(stage, "a.csv", ['1,"a",'])
    cat = loader.Catalog(spark, f"{workdir}/db")
    loader.copy_into(cat, "t", stage, SCHEMA, FORMAT_C, on_error="abort")
    assert rows(cat.table("t").read())[0][1] == '"a"'


def test_crash_before_commit_loses_nothing_and_duplicates_nothing(spark, workdir, monkeypatch):
    from spokewise.sources.tables import VersionedTable
    stage = f"{workdir}/stage"
    write(stage, "a.csv", ["1,a,", "2,b,"])
    write(stage, "b.csv", ["3,c,"])
    cat = loader.Catalog(spark, f"{workdir}/db")
    real = VersionedTable.append_segments

    def crash(self, *a, **k):
        raise SystemExit("driver lost before the commit")

    monkeypatch.setattr(VersionedTable, "append_segments", crash)
    with pytest.raises(SystemExit):
        loader.copy_into(cat, "t", stage, SCHEMA, FORMAT_B, on_error="abort")
    monkeypatch.setattr(VersionedTable, "append_segments", real)
    # staged data and ledger rows exist on disk but are not committed: invisible
    cat2 = loader.Catalog(spark, f"{workdir}/db")
    assert cat2.table("t").read().count() == 0
    assert cat2.load_history("t").count() == 0
    rep = loader.copy_into(cat2, "t", stage, SCHEMA, FORMAT_B, on_error="abort")
    assert rep.files == 2 and cat2.table("t").read().count() == 3
    assert loader.copy_into(cat2, "t", stage, SCHEMA, FORMAT_B, on_error="abort").files == 0
    assert cat2.table("t").read().count() == 3


def test_aborted_load_is_recorded_and_retried(spark, workdir):
    stage = f"{workdir}/stage"
    write(stage, "a.csv", ["1,a,", "x,b,"])
    cat = loader.Catalog(spark, f"{workdir}/db")
    with pytest.raises(loader.LoadError):
        loader.copy_into(cat, "t", stage, SCHEMA, STRICT, on_error="abort")
    assert [r["status"] for r in cat.load_history("t").collect()] == ["LOAD_FAILED"]
    # a failed file is not "loaded": a tolerant retry picks it up
    rep = loader.copy_into(cat, "t", stage, SCHEMA, STRICT, on_error="continue")
    assert rep.files == 1 and cat.table("t").read().count() == 1
    assert sorted(r["status"] for r in cat.load_history().collect()) == ["LOAD_FAILED", "PARTIALLY_LOADED"]


def test_pattern_glob_narrows_listing_and_regex_decides(spark, workdir):
    from spokewise.sources.stage import name_glob
    assert name_glob(r".*[.]csv[.]gz") == "*.csv.gz"
    assert name_glob(r".*.*[.]csv[.]gz") == "*.csv.gz"
    assert name_glob(r".*[.]csv.gz") == "*.csv?gz"
    assert name_glob(r"day=.*") is None and name_glob(r".*(a|b)") is None
    stage = f"{workdir}/stage"
    write(stage, "a.csv.gz", ["1,a,"], gz=True)
    write(f"{stage}/sub", "b.csv.gz", ["2,b,"], gz=True)
    write(stage, "c.csvXgz", ["3,c,"])
    write(stage, "d.json", ["{}"])
    names = lambda p: sorted(r["name"] for r in list_stage(spark, stage, p).collect())
    assert names(r".*[.]csv[.]gz") == ["a.csv.gz", "sub/b.csv.gz"]
    assert names(r".*[.]csv.gz") == ["a.csv.gz", "c.csvXgz", "sub/b.csv.gz"]
    assert names(r"sub/.*") == ["sub/b.csv.gz"]


def _two_columns():
    return StructType([StructField("a", IntegerType()), StructField("b", StringType())])


def test_odd_names_empty_files_and_small_batches(spark, workdir, monkeypatch):
    """Names that need encoding or look like globs are loaded once; every listed file gets a ledger row."""
    stage = f"{workdir}/stage"
    os.makedirs(stage)
    for k, name in enumerate(["my file.csv", "a[1].csv", "x+y%20z.csv", "q{1}.csv", "plain.csv"]):
        with open(f"{stage}/{name}", "w") as f:
            f.write(f"h1,h2\n{k},v{k}\n")
    with open(f"{stage}/header only.csv", "w") as f:
        f.write("h1,h2\n")
    monkeypatch.setattr(loader, "FILES_PER_BATCH", 2)
    cat = loader.Catalog(spark, f"{workdir}/db")
    fmt = CsvFormat(skip_header=1)
    first = loader.copy_into(cat, "t", stage, _two_columns(), fmt)
    again = loader.copy_into(cat, "t", stage, _two_columns(), fmt)
    assert (first.files, first.rows_loaded, again.files) == (6, 5, 0)
    assert sorted(r.a for r in cat.table("t").read().collect()) == [0, 1, 2, 3, 4]
    assert {r.file_name: r.row_count for r in cat.load_history("t").collect()}["header only.csv"] == 0


def test_stage_without_rows(spark, workdir):
    stage = f"{workdir}/stage"
    os.makedirs(stage)
    with open(f"{stage}/h.csv", "w") as f:
        f.write("h1,h2\n")
    cat = loader.Catalog(spark, f"{workdir}/db")
    report = loader.copy_into(cat, "t", stage, _two_columns(), CsvFormat(skip_header=1))
    assert (report.files, report.rows_loaded) == (1, 0)
    assert cat.table("t").read().collect() == []


def test_undone_loads_are_pending_again(spark, workdir):
    stage = f"{workdir}/stage"
    os.makedirs(stage)
    with open(f"{stage}/d.csv", "w") as f:
        f.write("1,x\n2,y\n")
    cat = loader.Catalog(spark, f"{workdir}/db")

    def load():
        return loader.copy_into(cat, "t", stage, _two_columns(), CsvFormat()).rows_loaded

    t = cat.table("t")
    assert (load(), load()) == (2, 0)
    t.replace(t.read(), "update")  # an update keeps what is loaded
    assert load() == 0
    t.restore_before(t.log()[1].query_id)
    assert load() == 2
    t.drop()
    t.undrop()
    assert load() == 0
    t.create_empty(_two_columns())
    assert (load(), t.read().count()) == (2, 2)
    assert cat.load_history("t").count() == 3


def test_two_handles_agree_and_versions_are_created_once(spark, workdir):
    from pyspark.sql import functions as F

    from spokewise.sources import fsio
    from spokewise.sources.tables import VersionedTable
    a, b = (VersionedTable(spark, f"{workdir}/t") for _ in range(2))
    a.create(spark.range(3).select(F.col("id").cast("int").alias("a"), F.lit("x").alias("b")))
    assert b.read().count() == 3
    a.append(a.read().limit(2))
    assert b.read().count() == 5 and b.append(b.read().limit(1)).version == 2 and a.read().count() == 6
    with pytest.raises(Exception):
        fsio.write_text(spark, f"{a.log_path}/{0:020d}.json", "{}")
    assert a.entry(0).op == "create" and VersionedTable(spark, f"{workdir}/t").read().count() == 6
