import hashlib
import tempfile

import duckdb
import pytest

from spokewise.llm import warc
from spokewise.llm.queries import ORACLE_SQL, op3_warc

SF = "/root/testdata/sf0.001"
DDL = "page_id long, url string, html string, digest string, path string, offset long, payload string, refers_to long"
BIG = "<p>" + "é" * 800
FAKE = ("x\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc"
        "\r\n\r\nWARC/1.0\r\nContent-Length: 7\r\n\r\n")
PAGES = [(1, "http://a/", BIG), (2, "http://b/", BIG), (3, None, "small"), (4, "http://c/\r\nWARC-Type: x", "small"),
         (5, "", ""), (6, "u", None), (7, "http://d/", FAKE * 40), (8, "http://e/", FAKE * 40), (None, "n", BIG),
         (9, "r", BIG), (9, "r", BIG), (10, "m", "WARC/1.0\r\n"), (-3, "neg", BIG)]


def pages(spark, rows=None):
    return spark.createDataFrame([(*r, "d", "p", 5, "z", 1) for r in (PAGES if rows is None else rows)], DDL)


def expected(rows):
    last = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if i is not None and len(b) >= 1000:
            last[b] = max(last.get(b, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        to = last.get(b) if i is not None and last.get(b) != i else None
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(map(str, out))


def test_edge_rows(spark):
    assert sorted(str(tuple(r)) for r in warc.page_digests(pages(spark)).collect()) == expected(PAGES)


def test_payloads_come_back_and_many_archives(spark):
    folder = tempfile.mkdtemp() + "/archives"
    for compression in ("gzip", "none"):
        out = warc.write_archives(pages(spark), f"{folder}-{compression}", archive_bytes=4000, compression=compression)
        rec = warc.read_archives(spark, out).collect()
        assert len({r.path for r in rec}) > 3
        got = sorted((r.record_id, bytes(r.payload)) for r in rec if r.type == "response")
        want = [(f"<urn:page:{'null' if i is None else i}>", (h or "").encode()) for i, _, h in PAGES
                if i not in (-3, 1, 2, 7)]
        assert got == sorted(want)
        assert not [r for r in rec if r.record_id == "<urn:page:99>"]  # inside payloads
        assert warc.broken_archives(spark, out).collect() == []


def test_null_and_repeated_ids_are_spread_over_archives(spark):
    rows = [(None, f"n{k}", f"<p>{k}" + "x" * 2000) for k in range(300)]
    rows += [(5, "again", BIG)] * 150 + [(k, f"u{k}", f"{k}" + "y" * 2000) for k in range(10, 150)] + [(6, "six", BIG)]
    assert sorted(r.page_id or 0 for r in warc._hot_ids(pages(spark, rows)).collect()) == [0, 5]
    out = warc.write_archives(pages(spark, rows), tempfile.mkdtemp() + "/archives", archive_bytes=40_000,
                              compression="none")
    sizes = [r["size"] for r in warc.candidates(spark, out, False).select("path", "size").distinct().collect()]
    assert max(sizes) < 120_000
    assert sorted(str(tuple(r)) for r in warc.page_digests(pages(spark, rows)).collect()) == expected(rows)


def test_broken_archive_is_reported(spark):
    folder = tempfile.mkdtemp() + "/archives"
    spark.createDataFrame([("WARC/1.0\r\nContent-Length: 3\r\n\r\nabc",), ("garbage",)], "value string").coalesce(
        1).write.option("lineSep", "\r\n\r\n").text(folder)
    rows = warc.broken_archives(spark, folder).collect()
    assert len(rows) == 1 and rows[0].chain_end == 38 < rows[0].size


def test_empty_table(spark):
    assert warc.page_digests(pages(spark, [])).collect() == []


def test_query_matches_sql(spark):
    duckdb.sql(f"create or replace view pages as select * from '{SF}/pages.parquet'")
    want = duckdb.sql(ORACLE_SQL["op3_warc"]).fetchall()
    cols = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in op3_warc(spark, SF).select(*cols).collect())


def test_very_long_url_keeps_the_chain(spark):
    rows = [*PAGES, (20, "data:," + "x" * 200_000, "<p>long url"), (21, "http://after/", BIG), (22, "u" * 65_536, BIG)]
    assert sorted(str(tuple(r)) for r in warc.page_digests(pages(spark, rows)).collect()) == expected(rows)


def test_digests_fail_on_a_broken_chain(spark, monkeypatch):
    write = warc.write_archives

    def cut(pages, folder):
        out = write(pages, folder)
        spark.createDataFrame([("garbage",)], "value string").write.mode("append").text(out)
        return out

    monkeypatch.setattr(warc, "write_archives", cut)
    with pytest.raises(ValueError, match="last byte"):
        warc.page_digests(pages(spark))
