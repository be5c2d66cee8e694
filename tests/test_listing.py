"""Listings against a walk of the folders; the ledger's shares, runs and empty files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from spokewise.sources import loader
from spokewise.sources.formats import CsvFormat
from spokewise.sources.stage import list_stage, path_batches
from spokewise.streaming import ingest, observe
from tests.test_loader import SCHEMA, write


def stage_of(root, files):
    for name, text in files.items():
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "w") as f:
            f.write(text)
        os.utime(f"{root}/{name}", (1_700_000_000, 1_700_000_000 + len(name)))


def test_listing_is_the_walk(spark, workdir):
    """Empty files, sizes, times, odd names; hidden names stay out."""
    files = {"a.csv": "x", "empty.csv": "", "day=1/b+c d%.csv": "yy", "day=1/deep/er/e.json": "", "_x=1/kept.csv": "z",
             "_tmp/no.csv": "n", ".hid": "n", "day=1/_no": "n", "day=2/.no/f.csv": "n"}
    stage_of(f"{workdir}/stage", files)
    seen = {k: v for k, v in files.items() if "no" not in k.replace("_x=1/kept", "") and k != ".hid"}
    got = {r.name: r for r in list_stage(spark, f"{workdir}/stage").collect()}
    assert set(got) == set(seen)
    for name, text in seen.items():
        assert got[name].size == len(text) and got[name].path == f"file:{workdir}/stage/{name}"
        assert got[name].last_modified == dt.datetime.fromtimestamp(1_700_000_000 + len(name), dt.timezone.utc).replace(tzinfo=None)
    df = list_stage(spark, f"{workdir}/stage")
    assert df.rdd.getNumPartitions() == 4      # the folder itself, day=1, day=2, _x=1
    assert {r.name for r in list_stage(spark, f"{workdir}/stage", r".*[.]json").collect()} == {"day=1/deep/er/e.json"}
    with pytest.raises(FileNotFoundError):
        list_stage(spark, f"{workdir}/nowhere")
    os.makedirs(f"{workdir}/nothing")
    assert list_stage(spark, f"{workdir}/nothing").count() == 0


def test_batches_cover_each_path_once(spark, workdir):
    paths = [f"file:/s/day={i % 7}/f{i}.csv" for i in range(503)]
    spark.createDataFrame([(p,) for p in paths], "path string").write.parquet(f"{workdir}/l")
    files = spark.read.parquet(f"{workdir}/l")
    for size in (40, 503, 1000):
        batches = list(path_batches(files, size))
        assert all(0 < len(b) <= size and b == sorted(b) for b in batches)
        assert sorted(p for b in batches for p in b) == sorted(paths)
    assert list(path_batches(files.where("path = 'none'"), 5)) == []


def test_empty_files_are_loaded_once(spark, workdir):
    write(f"{workdir}/stage", "a.csv", ["1,a,"])
    stage_of(f"{workdir}/stage", {"empty.csv": "", "sub/empty.csv": ""})
    cat = loader.Catalog(spark, f"{workdir}/db")
    first = loader.copy_into(cat, "t", f"{workdir}/stage", SCHEMA, CsvFormat())
    again = loader.copy_into(cat, "t", f"{workdir}/stage", SCHEMA, CsvFormat())
    assert (first.files, first.rows_loaded, again.files) == (3, 1, 0)
    assert sorted(r.row_parsed for r in cat.load_history("t").collect()) == [0, 0, 1]


def test_one_listing_a_load(spark, workdir, monkeypatch):
    calls = []
    real = loader.list_stage
    monkeypatch.setattr(loader, "list_stage", lambda *a: calls.append(a) or real(*a))
    monkeypatch.setattr(loader, "FILES_PER_BATCH", 3)
    for i in range(10):
        write(f"{workdir}/stage", f"f{i}.csv", [f"{i},a,"])
    cat = loader.Catalog(spark, f"{workdir}/db")
    assert loader.copy_into(cat, "t", f"{workdir}/stage", SCHEMA, CsvFormat()).files == 10
    assert len(calls) == 1
    pending = loader.pending_listing(cat, cat.table("t"), f"{workdir}/stage", None)
    assert "stage_files" not in pending._jdf.queryExecution().toString()     # from here on a written table


def test_ledger_lookup_reads_the_shares_of_the_listed_files(spark, workdir):
    for i in range(20):
        write(f"{workdir}/stage", f"f{i}.csv", [f"{i},a,"])
    cat = loader.Catalog(spark, f"{workdir}/db")
    loader.copy_into(cat, "t", f"{workdir}/stage", SCHEMA, CsvFormat())
    write(f"{workdir}/stage", "new.csv", ["99,a,"])
    pending = loader.pending_listing(cat, cat.table("t"), f"{workdir}/stage", r".*new[.]csv")
    plan = pending._jdf.queryExecution().executedPlan().toString()
    share = list_stage(spark, f"{workdir}/stage", ".*new[.]csv").select(loader.share_of(F.col("path"))).first()[0]
    pruned = plan[plan.index("PartitionFilters"):]
    assert f"= {share})" in pruned.replace("(share", "(share") and [r.name for r in pending.collect()] == ["new.csv"]


def test_ledger_runs_are_merged_and_restores_keep_theirs(spark, workdir, monkeypatch):
    monkeypatch.setattr(loader, "MERGE_RUNS", 2)
    cat = loader.Catalog(spark, f"{workdir}/db")
    t = cat.table("t")
    for i in range(5):
        write(f"{workdir}/stage", f"f{i}.csv", [f"{i},a,"])
        assert loader.copy_into(cat, "t", f"{workdir}/stage", SCHEMA, CsvFormat()).files == 1
    assert len(t.loaded_segments()) <= 3
    assert cat.ledger_of(t, live=True).count() == 5 and cat.load_history("t").count() == 5
    t.restore_before(t.log()[-1].query_id)
    assert loader.copy_into(cat, "t", f"{workdir}/stage", SCHEMA, CsvFormat()).files == 1
    assert sorted(r.id for r in t.read().collect()) == [0, 1, 2, 3, 4]


def test_pipe_files_without_rows_are_not_pending(spark, workdir):
    """A file with a header only and one without bytes get a ledger row once the pipe has taken them."""
    landing, raw, state = f"{workdir}/landing", f"{workdir}/raw", f"{workdir}/state"
    fmt = CsvFormat(skip_header=1)

    def run():
        return ingest.run_pipe_once(ingest.csv_source(spark, landing, SCHEMA, fmt), raw, state)

    stage_of(landing, {"a.csv": "id,name,t\n1,a,\n", "header only.csv": "id,name,t\n", "empty.csv": ""})
    assert observe.pending_files(spark, landing, raw).count() == 3
    assert run() == 1
    assert observe.pending_files(spark, landing, raw).count() == 0
    stage_of(landing, {"b.csv": "id,name,t\n2,a,\n", "later.csv": "id,name,t\n"})
    assert sorted(r.name for r in observe.pending_files(spark, landing, raw).collect()) == ["b.csv", "later.csv"]
    assert run() == 1 and run() == 0
    led = {os.path.basename(r["_file"]): r.row_parsed for r in ingest.read_pipe_ledger(spark, raw).collect()}
    assert led == {"a.csv": 1, "header only.csv": 0, "empty.csv": 0, "b.csv": 1, "later.csv": 0}


def test_many_folders_share_tasks(spark, workdir):
    files = {f"day={k:03d}/f.csv": "x" * k for k in range(100)}
    stage_of(f"{workdir}/stage", files)
    df = list_stage(spark, f"{workdir}/stage")
    assert df.rdd.getNumPartitions() <= 33
    assert sorted((r.name, r.size) for r in df.collect()) == [(f"day={k:03d}/f.csv", k) for k in range(100)]
