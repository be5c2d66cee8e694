"""Stages: a folder of immutable files.

A stage is listed by ``sources.listing``, its folders in parallel. Patterns
are full-match regular expressions over the path relative to the stage root,
like the dialect's ``PATTERN=`` option.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spokewise.functions._util import utc_ntz
from spokewise.session import new_workdir
from spokewise.sources.listing import StageFiles


def _root(path: str) -> str:
    return path.rstrip("/")


def name_glob(pattern: str) -> str | None:
    r"""A file-name glob implied by a full-match path regex, or None.

    Only the common shape ``.*<suffix>`` is translated: ``[.]`` and ``\.``
    are a literal dot, ``.*`` is ``*``, a bare ``.`` is ``?``, letters,
    digits, ``_`` and ``-`` stay. ``.*[.]csv[.]gz`` becomes ``*.csv.gz``.
    The glob only narrows the listing; the regex still decides.
    """
    if not pattern.startswith(".*"):
        return None
    out, i = ["*"], 2
    while i < len(pattern):
        if pattern.startswith(".*", i):
            out.append("*")
            i += 2
        elif pattern.startswith("[.]", i):
            out.append(".")
            i += 3
        elif pattern.startswith("\\.", i):
            out.append(".")
            i += 2
        elif pattern[i] == ".":
            out.append("?")
            i += 1
        elif pattern[i].isalnum() or pattern[i] in "_-":
            out.append(pattern[i])
            i += 1
        else:
            return None
    glob = "".join(out)
    while "**" in glob:
        glob = glob.replace("**", "*")
    return glob


def list_stage(spark: SparkSession, stage: str, pattern: str | None = None) -> DataFrame:
    """``list @stage [pattern=...]``: one row per file (path, name, size, modified), files without bytes too.

    Each evaluation lists the stage again; write the result where it is used more than once.
    """
    spark.dataSource.register(StageFiles)
    reader = spark.read.format("stage_files")
    glob = name_glob(pattern) if pattern else None
    if glob:
        reader = reader.option("name_glob", glob)   # applied where the files are listed; the regex decides
    out = reader.load(qualified(spark, _root(stage)))
    if pattern:
        out = out.where(F.col("name").rlike(f"^(?:{pattern})$"))
    return out


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark names files (``file:/x``); the folder has to exist."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        raise FileNotFoundError(f"stage {path} does not exist")
    return fs.makeQualified(p).toString()


def plain_path(file_path) -> "F.Column":
    """``_metadata.file_path`` in the form that listings have.

    The hidden column is URL-encoded (``my%20file.csv``), a listing is not. A
    plus sign is a plus sign in a path, so it is protected from the decoder.
    """
    c = F.col(file_path) if isinstance(file_path, str) else file_path
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def literal_paths(paths: list[str]) -> list[str]:
    """Paths for a reader that takes globs: names with glob characters stand for themselves."""
    import re
    return [re.sub(r"([\\*?\[\]{}])", r"\\\1", p) for p in paths]


def path_batches(files: DataFrame, size: int) -> Iterator[list[str]]:
    """The paths of a *written* listing, at most ``size`` at a time, so that the driver never
    holds the list of a whole stage. A longer listing is dealt once into ranges of paths,
    each of which is then one folder to read."""
    first = [r.path for r in files.select("path").limit(size + 1).collect()]
    if len(first) <= size:
        if first:
            yield sorted(first)
        return
    spark = files.sparkSession
    ranges = -(-2 * files.count() // size)
    place = F.row_number().over(Window.partitionBy("part").orderBy("path"))
    dealt = new_workdir(spark, "batches") + "/files"
    (files.select("path").repartitionByRange(ranges, "path").withColumn("part", F.spark_partition_id())
     .withColumn("piece", F.floor((place - 1) / size).cast("int")).write.partitionBy("part", "piece").parquet(dealt))
    pieces = spark.read.schema("path string, part int, piece int").parquet(dealt)
    for p in pieces.select("part", "piece").distinct().orderBy("part", "piece").collect():
        yield sorted(r.path for r in pieces.where((F.col("part") == p.part) & (F.col("piece") == p.piece)).collect())


def with_provenance(df: DataFrame) -> DataFrame:
    """``metadata$filename`` and file time (UTC wall clock) from the hidden ``_metadata`` column."""
    return df.select("*", plain_path("_metadata.file_path").alias("_file"),
                     utc_ntz(F.col("_metadata.file_modification_time")).alias("_file_time"))


def day_of_path(path_col) -> "F.Column":
    """The ``day=YYYY-MM-DD`` folder of a staged file path, as a DATE; null without one."""
    c = F.col(path_col) if isinstance(path_col, str) else path_col
    return F.to_date(F.nullif(F.regexp_extract(c, r"day=(\d{4}-\d{2}-\d{2})", 1), F.lit("")))
