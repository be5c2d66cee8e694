"""Small metadata files through the Hadoop FileSystem API (any Hadoop-supported store).

Version logs and run logs are a few hundred bytes per entry. Writing them
as Spark jobs would cost a job per entry; the driver writes them directly,
the way Spark writes its own commit and offset logs. Data never goes
through here.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def has_data_files(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds at least one file not hidden by a ``_`` or ``.`` prefix."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    it = fs.listFiles(p, True)
    while it.hasNext():
        name = it.next().getPath().getName()
        if not name.startswith("_") and not name.startswith("."):
            return True
    return False


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """Create ``path`` with ``text``, whole or not at all.

    The bytes go to a hidden temporary file first, which is then renamed, so
    no reader sees a torn file. With ``overwrite=False`` an existing file is
    an error (rename without overwrite), which makes "create version N" a
    compare-and-set.
    """
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    temp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    out = fs.create(temp, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE if overwrite else rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(p).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(temp), fs.makeQualified(p), how)
    except Exception:
        fs.delete(temp, False)
        raise


def make_dir(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def rename(spark: SparkSession, path: str, to: str) -> None:
    fs, p = _fs(spark, path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)
    fs.mkdirs(target.getParent())
    if not fs.rename(p, target):
        raise OSError(f"cannot rename {path} to {to}")


def delete_file(spark: SparkSession, path: str) -> bool:
    """Delete one file; False when it is not there."""
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, False))


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    """Names of the plain files directly under ``path`` (not recursive), sorted."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]
    return sorted(n for n in names if n.endswith(suffix) and not n.startswith((".", "_")))
