"""Ordinals and pieces of string aggregates, formats found from tokens, masks bound to tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType, TimestampNTZType

from spokewise.functions.ordering import asc_nulls_largest
from spokewise.operators.masking import SIMPLE_MASK_INT, SIMPLE_MASK_STRING, use_role
from spokewise.operators.ordered import listagg_pieces, with_ordinal
from spokewise.sources import loader
from spokewise.sources.formats import CsvFormat
from tests.test_loader import write


def test_ordinals_with_ties_and_nulls(spark):
    rng = random.Random(1)
    values = [rng.choice([None, 1, 1, 1, 2, rng.randrange(3, 900)]) for _ in range(700)]   # one value holds a third
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(6)
    got = sorted((r.ordinal, r.v) for r in with_ordinal(df, [asc_nulls_largest("v")]).collect())
    assert [o for o, _ in got] == list(range(1, 701))
    assert [v for _, v in got] == sorted(values, key=lambda v: (v is None, v))
    assert with_ordinal(df.where("v < 0"), [F.col("v").asc()]).count() == 0


@pytest.mark.parametrize("per_piece", [1, 7, 1000])
def test_pieces_join_to_the_whole_aggregate(spark, per_piece):
    names = [f"day={i % 9}/f{i:03}.csv" for i in range(100)] + [None]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(5)
    rows = sorted(listagg_pieces(df, "name", "|", per_piece).collect())
    assert "|".join(r.name for r in rows) == "|".join(sorted(n for n in names if n))
    assert [r.piece for r in rows] == list(range(len(rows))) and all(r.n <= per_piece for r in rows)


TIMES = StructType([StructField("id", IntegerType()), StructField("t", TimestampNTZType()), StructField("d", DateType())])


def load_times(spark, workdir, lines, name="s"):
    write(f"{workdir}/{name}", "a.csv", lines)
    cat = loader.Catalog(spark, f"{workdir}/{name}-db")
    rep = loader.copy_into(cat, "t", f"{workdir}/{name}", TIMES, CsvFormat(timestamp_formats=("AUTO",)), on_error="continue")
    return rep, [tuple(r)[1:] for r in cat.table("t").read().orderBy("id").collect()]


@pytest.mark.parametrize("t, d, want", [
    (["2024-03-05 01:02:03.5", "2024-03-05T01:02:03"], ["2024-03-05", "2024-3-6"],
     [(dt.datetime(2024, 3, 5, 1, 2, 3, 500000), dt.date(2024, 3, 5)), (dt.datetime(2024, 3, 5, 1, 2, 3), dt.date(2024, 3, 6))]),
    # 25 can only be a day, so the first token is 5 March too
    (["05/03/2024 10:00", "25/03/2024 11:30"], ["03/05/2024", "03/25/2024"],
     [(dt.datetime(2024, 3, 5, 10), dt.date(2024, 3, 5)), (dt.datetime(2024, 3, 25, 11, 30), dt.date(2024, 3, 25))]),
    (["1709600000", "-1"], ["05-Mar-2024", ""],
     [(dt.datetime(2024, 3, 5, 0, 53, 20), dt.date(2024, 3, 5)), (dt.datetime(1969, 12, 31, 23, 59, 59), None)]),
    (["1709600000123", "1709600000123456"], ["1709600000", "0"],
     [(dt.datetime(2024, 3, 5, 0, 53, 20, 123000), dt.date(2024, 3, 5)), (dt.datetime(2024, 3, 5, 0, 53, 20, 123456), dt.date(1970, 1, 1))]),
])
def test_formats_are_found_per_column(spark, workdir, t, d, want):
    rep, got = load_times(spark, workdir, [f"{i},{a},{b}" for i, (a, b) in enumerate(zip(t, d, strict=True))])
    assert got == want and rep.rows_rejected == 0


def test_tokens_of_another_format_are_rejected(spark, workdir):
    rep, got = load_times(spark, workdir, ["1,2024-01-01 00:00:00,", "2,2024-01-02 00:00:00,", "3,01/03/2024 00:00:00,", "4,31/31/2024,"])
    assert len(got) == 2 and rep.rows_rejected == 2


def test_bound_masks_follow_the_session_role(spark, workdir):
    schema = StructType([StructField("k", StringType()), StructField("n", IntegerType())])
    cat = loader.Catalog(spark, f"{workdir}/db")
    cat.table("t").create(spark.createDataFrame([("a", 1), ("b", None)], schema))
    assert cat.read("t").count() == 2 and cat.masks("t") == {}
    cat.set_masks("t", {"k": SIMPLE_MASK_STRING, "n": SIMPLE_MASK_INT})
    again = loader.Catalog(spark, f"{workdir}/db")       # another handle finds the binding
    assert {tuple(r) for r in again.read("t").collect()} == {("*** masked ***", -999)}
    assert again.read("t").where("k = 'a'").count() == 0 and again.read("t").agg(F.sum("n")).first()[0] == -1998
    use_role(spark, "accountadmin")
    try:
        assert sorted(r.k for r in again.read("t").collect()) == ["a", "b"]
        assert again.read("t", role="SYSADMIN").where("n > 0").count() == 0
    finally:
        use_role(spark, "PUBLIC")
    again.table("t").append(spark.createDataFrame([("c", 3)], schema))
    assert {r.k for r in again.read("t").collect()} == {"*** masked ***"}
    with pytest.raises(ValueError):
        again.set_masks("t", {"n": SIMPLE_MASK_STRING})
    with pytest.raises(ValueError):
        again.set_masks("t", {"nowhere": SIMPLE_MASK_STRING})
    again.set_masks("t", {})
    assert sorted(r.k for r in again.read("t").collect()) == ["a", "b", "c"]
