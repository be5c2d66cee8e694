"""Records that span lines: against a reader that goes character by character, with blocks of a few bytes."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from spokewise.sources import loader, records
from spokewise.sources.formats import CsvFormat

ESCAPES = CsvFormat(quote='"', escape_unenclosed="\\", record_delimiter="\n")
QUOTES = CsvFormat(quote='"')
BARE = CsvFormat(escape_unenclosed="\\")
SCHEMA = StructType([StructField("id", IntegerType()), StructField("name", StringType()), StructField("n", IntegerType())])


def plain_records(text, fmt):
    """The records of a file, one character after the other."""
    out, now, state, i = [], "", "field", 0
    if text.endswith("\n"):
        text = text[:-1]
    while i < len(text):
        c = text[i]
        pair = text[i:i + 2]
        if state == "quoted":
            if pair == '""':
                now, i = now + pair, i + 2
                continue
            state = "bare" if c == fmt.quote else "quoted"
        elif c == "\n":
            out.append(now)
            now, state, i = "", "field", i + 1
            continue
        elif c == fmt.quote and state == "field":
            state = "quoted"
        elif c == fmt.escape_unenclosed:
            now, state, i = now + pair, "bare", i + 2
            continue
        else:
            state = "field" if c == "," else "bare"
        now, i = now + c, i + 1
    return [r for r in [*out, now] if r.strip(" ")]


def write(stage, name, text):
    import os
    os.makedirs(stage, exist_ok=True)
    with open(f"{stage}/{name}", "w", newline="") as f:
        f.write(text)


def cut(spark, workdir, stage, fmt):
    n = iter(range(99))

    def table(df):
        path = f"{workdir}/cut{next(n)}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    lines = records.read_lines(spark, [stage], fmt)
    found = records.gathered(records.numbered(lines, fmt, table), fmt)
    got = {}
    for r in found.select("file", "record").collect():
        got.setdefault(r.file.rsplit("/", 1)[-1], []).append(r.record)
    return {k: sorted(v) for k, v in got.items()}, {r.file.rsplit("/", 1)[-1] for r in records.open_files(lines, fmt).collect()}


@pytest.mark.parametrize("fmt", [ESCAPES, QUOTES, BARE], ids=["escapes", "quotes", "bare"])
def test_records_of_random_bytes_in_small_blocks(spark, workdir, fmt):
    """Any text, cut in blocks of 1 MB and 7 bytes, has the records that a plain reader finds."""
    rng = random.Random(7)
    stage = f"{workdir}/stage"
    texts = {}
    for k in range(25):
        text = "".join(rng.choice('a,b"\n\\,"\n') for _ in range(rng.randrange(1, 160)))
        if fmt.escape_unenclosed is None:
            text = text.replace("\\", "c")
        texts[f"f{k}.csv"] = text.rstrip("\\") + "\n"
        write(stage, f"f{k}.csv", texts[f"f{k}.csv"])
    want = {k: sorted(plain_records(t, fmt)) for k, t in texts.items()}
    want = {k: v for k, v in want.items() if v}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1m", "7"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got, odd = cut(spark, f"{workdir}/{size}", stage, fmt)
            assert got == want
            # a file that is not reported has one record per line
            for k in set(texts) - odd:
                assert sorted(x for x in texts[k].split("\n") if x.strip(" ")) == want.get(k, [])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def token(value, rng, fmt):
    if value is None:
        return ""
    if fmt.quote and (rng.random() < 0.5 or not fmt.escape_unenclosed or "\n" in value or value[:1] == '"'):
        return '"' + value.replace('"', '""') + '"'
    return "".join("\\" + c if c in ',\n\\' + (fmt.quote or '') else c for c in value)


@pytest.mark.parametrize("fmt", [ESCAPES, QUOTES, BARE], ids=["escapes", "quotes", "bare"])
def test_fields_round_trip(spark, fmt):
    rng = random.Random(11)
    rows, texts = [], []
    for _ in range(150):
        alphabet = 'xy ,"\n\\é' if fmt is not QUOTES else 'xy ,"\né'
        row = [None if rng.random() < 0.1 else "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 9))) for _ in range(4)]
        rows.append(row)
        texts.append(",".join(token(v, rng, fmt) for v in row))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, record string")
    got = df.select("i", records.fields_of(F.col("record"), fmt).alias("f")).collect()
    assert [r.f for r in sorted(got)] == rows


def test_load_takes_whole_records(spark, workdir):
    """Enclosed line ends and escaped delimiters load whole, also where the column count is tolerated."""
    stage = f"{workdir}/stage"
    write(stage, "a.csv", 'id,name,n\n1,"x\ny",5\n2,a\\,b,6\n3,"p,""q""",\n\n4,"\n\n",7\n')
    write(stage, "b.csv", "id,name,n\n5,plain,8\n6,short\n")
    fmt = CsvFormat(quote='"', escape_unenclosed="\\", skip_header=1, error_on_column_count_mismatch=False)
    cat = loader.Catalog(spark, f"{workdir}/db")
    rep = loader.copy_into(cat, "t", stage, SCHEMA, fmt, on_error="continue")
    assert (rep.files, rep.rows_loaded, rep.rows_rejected) == (2, 6, 0)
    assert sorted(tuple(r) for r in cat.table("t").read().collect()) == [
        (1, "x\ny", 5), (2, "a,b", 6), (3, 'p,"q"', None), (4, "\n\n", 7), (5, "plain", 8), (6, "short", None)]


def test_strict_counts_rejects_and_quote_that_never_closes(spark, workdir, monkeypatch):
    stage = f"{workdir}/stage"
    write(stage, "a.csv", '1,"x\ny",5\n2,"x\ny"\n3,"x\ny",4,extra\nz,"x\ny",5\n')
    write(stage, "b.csv", '7,ok,1\n8,"never closed,1\n' + "9,lost,1\n" * 40)
    monkeypatch.setattr(records, "MAX_RECORD", 200)
    cat = loader.Catalog(spark, f"{workdir}/db")
    loader.copy_into(cat, "t", stage, SCHEMA, QUOTES, on_error="continue", rejects_table="rj")
    assert sorted(r.id for r in cat.table("t").read().collect()) == [1, 7]
    errors = sorted(r["_error"] for r in cat.table("rj").read().collect())
    assert errors == ["cannot convert 'id': z", "column count mismatch", "column count mismatch", "record too long"]


def test_carriage_returns_belong_to_the_line_end(spark, workdir):
    stage = f"{workdir}/stage"
    write(stage, "a.csv", '1,"x\r\ny",5\r\n2,b,6\r\n')
    cat = loader.Catalog(spark, f"{workdir}/db")
    loader.copy_into(cat, "t", stage, SCHEMA, QUOTES, on_error="continue")
    assert sorted(tuple(r) for r in cat.table("t").read().collect()) == [(1, "x\r\ny", 5), (2, "b", 6)]


def test_plain_files_are_not_shuffled(spark, workdir):
    stage = f"{workdir}/stage"
    write(stage, "a.csv", '1,"x",5\n2,b"c,6\n')
    parsed = loader.parse_csv(spark, [f"file:{stage}/a.csv"], SCHEMA, QUOTES)
    assert "Exchange" not in parsed._jdf.queryExecution().executedPlan().toString()


def test_blocks_are_chained_without_sorting_their_lines(spark, workdir):
    stage = f"{workdir}/chained"
    write(stage, "a.csv", '1,"x\ny",5\n2,a\\,b,6\n')
    fmt = CsvFormat(record_delimiter="\n", quote='"', escape_unenclosed="\\")
    lines = records.read_lines(spark, [stage], fmt)

    def table(df):
        df.write.parquet(f"{workdir}/chained-lines")
        return spark.read.schema(df.schema).parquet(f"{workdir}/chained-lines")
    plan = records.numbered(lines, fmt, table)._jdf.queryExecution().executedPlan().toString()
    assert "max_by" not in plan and "SortAggregate" not in plan
