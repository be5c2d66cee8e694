"""WARC writing and reading with boundary-chain verification.

Writing: one ``WARC/1.0`` record per page, through Spark's text writer
(each row is header and payload, the writer's line separator is the blank
lines that end a record), into archives of bounded size in a shared folder.
Equal payloads are written once: the page with the largest id is a
``response`` record, the others are ``revisit`` records without a body.

Reading: the byte pattern that starts a record may also stand inside a
payload. Tasks therefore emit every place of the pattern as a candidate
with the offset of its successor (header end + Content-Length + 4).
Pointer jumping from each archive's first byte keeps the candidates that
the chain reaches: in every round reachable offsets are joined with jumps
of 1, 2, 4, ... records, so an archive of n records takes log2(n) rounds.
Candidates outside the chain are payload bytes and fall away.

Defined results: a null html is an empty payload; payloads of fewer than
``min_bytes`` bytes are always responses; a null page id is always a
response and reads back as null; rows that repeat the largest id of equal
payloads are all responses; CR and LF in a url are written as %0D and %0A,
a null url has no target line. An empty table gives no archive and an
empty result. An archive whose chain does not end at its last byte is
reported by ``broken_archives``, and ``page_digests`` fails on one. Headers
may be of any length. Archives are read whole, one at a time, by
a task: write them with a size that an executor can hold.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spokewise.llm.common import written
from spokewise.session import new_workdir

# The record syntax of WARC 1.0.
MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

MIN_BYTES = 1000            # payloads from this size on are written once
ARCHIVE_BYTES = 16 << 20    # aimed at for one archive
HOT_SHARE, HOT_LEAST = 1000, 64  # ids with over 1 in HOT_SHARE rows (and so many) are dealt in turn
EMPTY_GZIP = 20             # bytes of a gzip file without content

_HEADER = "offset long, next long, record_id string, type string, refers_id string, uri string, digest string, " \
          "bytes long, sha1 string, payload binary"


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def plan_revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload another page with a larger id has too.

    Only ids and digests are shuffled. Copies fold to one row a task before the shuffle, and the join
    reads two written tables, so that a digest with many copies can be split.
    """
    keys = written(pages.where(F.col("page_id").isNotNull() & (F.octet_length("html") >= min_bytes)).select(
        "page_id", F.unhex(F.sha1(F.encode("html", "UTF-8"))).alias("digest")), "warc-digests")
    last = keys.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("first_id"))
    last = written(last.where("first_id < refers_to").select("digest", "refers_to"), "warc-copies")
    return keys.join(last, "digest").where("page_id < refers_to").select(
        "page_id", F.lower(F.hex("digest")).alias("digest"), "refers_to").distinct()


def _hot_ids(pages: DataFrame) -> DataFrame:
    """(page_id) of the ids, null included, that hold over 1 in ``HOT_SHARE`` rows: fewer ids than that."""
    ids = pages.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))
    total = pages.agg(F.count(F.lit(1)).alias("total"))
    return ids.where(F.col("n") >= HOT_LEAST).join(F.broadcast(total), F.col("n") * HOT_SHARE > F.col("total")).select(
        "page_id")


def plan_records(pages: DataFrame, n: int, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, refers_to) in ``n`` partitions; ``refers_to`` is set for revisits.

    The payloads are shuffled once, by page id. Rows of an id with many rows (null, or one that is given
    again and again) are dealt in turn instead, into as many partitions more as their share asks for.
    """
    revisits = written(plan_revisits(pages, min_bytes), "warc-revisits")
    hot = [r.page_id for r in _hot_ids(pages).collect()]  # fewer than HOT_SHARE ids
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    digest = F.sha1(F.encode("payload", "UTF-8"))

    def planned(rows: DataFrame, refers: DataFrame) -> DataFrame:
        return rows.withColumn("digest", digest).join(refers, ["page_id", "digest"], "left").select(
            "page_id", "url", "payload", "digest", "refers_to")

    if not hot:
        return planned(p.repartition(n, "page_id"), revisits.repartition(n, "page_id").hint("shuffle_hash"))
    often = F.coalesce(F.col("page_id").isin([i for i in hot if i is not None]), F.lit(False))
    if None in hot:
        often = often | F.col("page_id").isNull()
    share = pages.agg(F.avg(often.cast("double"))).first()[0]
    usual = planned(p.where(~often).repartition(n, "page_id"),
                    revisits.where(~often).repartition(n, "page_id").hint("shuffle_hash"))
    # an id's payloads are few or its rows differ: joined where they are, the adaptive join splits a hot key
    many = planned(p.where(often), revisits.where(often)).repartition(1 + int(n * share))
    return usual.unionByName(many)


def record(row_type: str = "refers_to") -> Column:
    """Header and payload of a planned record, as the text of one record without its end."""
    revisit = F.col(row_type).isNotNull()
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    lines = [
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _urn(F.col("page_id"))),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _urn(F.col(row_type)))),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    ]
    return F.concat(F.lit(MAGIC), F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), body)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES, compression: str = "gzip") -> str:
    """Write one record per row of ``pages`` (page_id, url, html) into archives below ``folder``
    (``compression``: gzip or none, of the whole archive)."""
    size = pages.agg(F.sum(F.coalesce(F.octet_length("html"), F.lit(0)).cast("long")
                            + F.coalesce(F.octet_length("url"), F.lit(0)) + 512)).first()[0] or 0
    rows = plan_records(pages, 1 + size // archive_bytes, min_bytes).select(record().alias("value"))
    rows.write.option("lineSep", END).option("compression", compression).text(folder)
    return folder


class _Fields:
    """Header lines of ``data`` by name. Places are asked for in rising order and every match is kept
    until it is passed, so that all questions together read the data once per name."""

    def __init__(self, data: bytes):
        self.data, self.found = data, {}

    def get(self, name: bytes, at: int, end: int) -> str | None:
        """Value of the first line of that name between ``at`` and ``end``."""
        m = self.found.get(name, False)
        if m is False or m is not None and m.start() < at:
            m = self.found[name] = re.compile(rb"(?im)^" + re.escape(name) + rb":([^\n]*)").search(self.data, at)
        if m is None or m.start() >= end:
            return None
        return m[1].removesuffix(b"\r").strip(b" \t").decode("utf-8", "replace")


def _candidates(data: bytes) -> Iterator[tuple]:
    """Every place of the magic with the header fields, payload and the offset of its successor."""
    magic, fields, end = MAGIC.encode(), _Fields(data), -1
    at = data.find(magic)
    while at >= 0:
        if end < at:
            end = data.find(b"\r\n\r\n", at)
            if end < 0:
                return
        length = fields.get(b"Content-Length", at, end)
        if length is not None and length.isascii() and length.isdigit() and len(length) < 19:
            start, stop = end + 4, end + 4 + int(length)
            if data[stop:stop + 4] == b"\r\n\r\n":
                yield (at, stop + 4, *(fields.get(x, at, end) for x in (
                    b"WARC-Record-ID", b"WARC-Type", b"WARC-Refers-To", b"WARC-Target-URI", b"WARC-Payload-Digest")),
                       start, stop)
        at = data.find(magic, at + 1)


def candidates(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """One row per candidate record of the archives in ``folder``; size, offset and next count the bytes
    of the archive's plain text. Without ``payloads`` only their length and digest are kept."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")
    schema = f"path string, size long, {_HEADER}"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0), b.column(1)):
                data, path, rows = content.as_py(), path.as_py(), []
                if data[:2] == b"\x1f\x8b":
                    data = gzip.decompress(data)
                for x in _candidates(data):
                    body = data[x[-2]:x[-1]]
                    rows.append((path, len(data), *x[:-2], len(body), hashlib.sha1(body).hexdigest(),
                                 body if payloads else None))
                    if len(rows) == 1000:
                        yield _batch(rows, kinds, names)
                        rows = []
                if rows:
                    yield _batch(rows, kinds, names)

    return files.mapInArrow(run, schema).withColumn("archive", F.xxhash64("path"))


def _batch(rows: list[tuple], kinds: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names=names)


def reachable(links: DataFrame) -> DataFrame:
    """(archive, offset) of the candidates that the chain from offset 0 reaches; ``links`` has archive,
    offset and next.

    After k rounds ``jump`` goes 2**k records ahead and all records below the 2**k-th are reached.
    """
    jump = links.select("archive", "offset", "next")
    reached = jump.where("offset = 0").select("archive", "offset")
    n = reached.count()
    while n:
        ahead = reached.join(jump, ["archive", "offset"]).select("archive", F.col("next").alias("offset"))
        ahead = ahead.join(links.select("archive", "offset"), ["archive", "offset"], "left_semi")
        reached = written(reached.union(ahead).distinct(), "warc-reached")
        far = jump.select("archive", F.col("offset").alias("start"), F.col("next").alias("offset"))
        jump = written(far.join(jump, ["archive", "offset"]).select("archive", F.col("start").alias("offset"), "next"),
                       "warc-jumps")
        n, before = reached.count(), n
        if n == before:
            break
    return reached


def _chained(spark: SparkSession, folder: str, payloads: bool) -> DataFrame:
    """The candidates that the chains reach."""
    found = written(candidates(spark, folder, payloads), "warc-candidates")
    chain = reachable(found.select("archive", "offset", "next"))
    return found.join(chain, ["archive", "offset"], "left_semi")


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the archives: path, offset, record_id, type, refers_id, uri, digest (as the header
    has it), bytes and sha1 of the payload, payload (binary; null without ``payloads``)."""
    return _chained(spark, folder, payloads).drop("archive", "size", "next")


def _broken(spark: SparkSession, folder: str, chained: DataFrame) -> DataFrame:
    ends = chained.groupBy("path").agg(F.max("next").alias("chain_end"), F.max("size").alias("size"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    # a task without pages writes no text: nothing, or a gzip frame of EMPTY_GZIP bytes
    files = files.where((F.col("length") > 0) & ~(F.col("path").endswith(".gz") & (F.col("length") <= EMPTY_GZIP)))
    files = files.select("path")
    return files.join(ends, "path", "left").where("chain_end is null or chain_end != size").select(
        "path", "size", "chain_end")


def broken_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size, chain_end) of archives whose chain does not end at the last byte (null: no chain)."""
    return _broken(spark, folder, _chained(spark, folder, False))


def page_digests(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages``, read the archives back and return the contract's columns per record."""
    spark = pages.sparkSession
    folder = write_archives(pages, folder or new_workdir(spark, "warc") + "/archives")

    def number(c: str) -> Column:
        return F.regexp_extract(F.coalesce(c, F.lit("")), r"^<urn:page:(-?\d+)>$", 1).try_cast("long")

    rec = written(_chained(spark, folder, payloads=False).select(
        "path", "size", "next", number("record_id").alias("page_id"), "type", number("refers_id").alias("refers_to"),
        "bytes", "sha1"), "warc-records")
    broken = _broken(spark, folder, rec).limit(3).collect()
    if broken:
        raise ValueError(f"archives whose records do not reach the last byte: {broken}")
    # a revisit's payload is its response's
    full = rec.where("type = 'response' and page_id is not null").select(
        F.col("page_id").alias("refers_to"), F.col("bytes").alias("r_bytes"), F.col("sha1").alias("r_sha1"))
    full = full.where(F.col("r_bytes") >= MIN_BYTES).distinct()
    # responses name no other record: they stay out of the join
    own = rec.where(~F.col("type").eqNullSafe("revisit")).select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("sha1").alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to")
    others = rec.where("type = 'revisit'").join(full, "refers_to", "left").select(
        "page_id", F.col("r_bytes").alias("payload_bytes"), F.col("r_sha1").alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to")
    return own.unionByName(others)
