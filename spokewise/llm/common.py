"""Helpers shared by the operators: tables, words, written intermediates, let-binding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spokewise.session import new_workdir

#: A word is a run of anything but these bytes (space, tab, LF, VT, FF, CR).
BLANKS = " \t\n\x0b\x0c\r"
NOT_BLANK = r"[^\x20\x09-\x0D]"
BLANK_RUN = r"[\x20\x09-\x0D]+"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared work folder and read it back.

    Cuts the lineage with data that every executor can reach; a lost
    executor costs nothing that was already written. The shuffles of the
    write are removed as it ends, not when the driver next collects its
    garbage: what follows reads the table.
    """
    spark = df.sparkSession
    path = new_workdir(spark, tag) + "/data"
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.select("*").write.parquet(path)   # a frame keeps the setting that it was made under
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing reads any more (what came of them is written itself)."""
    for df in tables:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A lambda that mentions an outer expression evaluates it again for every
    element; binding it as the element of a one-item array avoids that.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Array of the words of ``text``; null and blank texts have none."""
    spaced = F.coalesce(text, F.lit(""))
    for c in BLANKS[1:]:
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    return F.filter(F.split(spaced, " "), lambda w: w != "")  # one plain character: no regex engine


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0 (a null id counts as the empty text)."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def one_text_an_id(docs: DataFrame, *columns: str) -> DataFrame:
    """(doc_id, text, columns), a row for each id: of several texts the first by hash, null last. The other
    columns depend on the id alone. The choice does not depend on the order of rows."""
    return docs.groupBy("doc_id", *columns).agg(F.min(F.struct(
        F.col("text").isNull().alias("none"), F.xxhash64("text").alias("hash"), "text")).alias("least")).select(
        "doc_id", "least.text", *columns)
