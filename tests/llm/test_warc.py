"""Operator 10: the files themselves, and the round trip against SQL."""

import gzip
import hashlib
import json
import re
import tracemalloc
import zlib
from base64 import b32encode

import duckdb
import pytest

from starload.llm import warc
from tests.llm import helpers as h

ROWS = [
    (1, "http://a/1", "<p>same</p>"),
    (2, "http://a/2", "<p>same</p>"),
    (5, "http://a/5", "<p>same</p>"),
    (3, None, None),
    (4, "http://a/4\r\nX: y", ""),
    (6, "http://é/", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (7, "", "\r\n\r\n\r\n\r\n"),
    (8, "http://b/", "日本   " * 50_000),
    (None, "http://c/", "<p>same</p>"),
    (None, "http://c/", "alone"),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def plain(rows, least=0):
    groups = {}
    for p, _, t in rows:
        groups.setdefault(t or "", []).append(p)
    out = []
    for p, _, t in rows:
        data = (t or "").encode()
        known = [x for x in groups[t or ""] if x is not None]
        top = max(known, default=None)
        revisit = len(data) >= least and top is not None and p != top
        out.append((p, len(data), b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", top if revisit else None))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x) for x in r))


def test_round_trip(spark):
    assert order(warc.archived(frame(spark).repartition(3)).collect()) == order(plain(ROWS))


def test_files(spark, tmp_path):
    """Before: one member a file. After: one for each record, where the index says."""
    warc.write_monolithic(frame(spark).repartition(2), f"file://{tmp_path}/whole", most=3)
    whole = sorted((tmp_path / "whole").glob("*.gz"))
    assert len(whole) >= 4
    for p in whole:
        z = zlib.decompressobj(31)
        z.decompress(p.read_bytes())
        assert z.eof and not z.unused_data
    index = warc.normalise(spark, f"file://{tmp_path}/whole", f"file://{tmp_path}/single")
    rows = index.collect()
    assert len(rows) == len(ROWS) and not list((tmp_path / "single").glob("_attempt*"))
    for p in (tmp_path / "single").glob("*.gz"):
        own = sorted((r for r in rows if r.archive == p.name), key=lambda r: r.at)
        data, at = p.read_bytes(), 0
        for r in own:
            assert r.at == at
            record = gzip.decompress(data[at : at + r.length])
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            at += r.length
        assert at == len(data)
        lines = [json.loads(x) for x in (p.parent / f"{p.name}.idx").read_text().splitlines()]
        assert lines == [r.asDict() for r in own]
        joined = gzip.decompress(data)
        assert joined in [gzip.decompress(w.read_bytes()) for w in whole]
    back = warc.read_records(index, f"file://{tmp_path}/single")
    got = {(r.page_id, r.url): r.payload for r in back.collect()}
    assert bytes(got[8, "http://b/"]).decode() == ROWS[7][2] and got[1, "http://a/1"] is None
    assert bytes(got[6, "http://é/"]).decode() == ROWS[5][2] and (3, None) in got and (4, "http://a/4%0D%0AX: y") in got


def test_smaller_payloads_are_all_responses(spark):
    got = warc.records(frame(spark), least_bytes=12).select("page_id", "refers_to").collect()
    assert all(r.refers_to is None for r in got)
    assert sum(r.refers_to is not None for r in warc.records(frame(spark), least_bytes=11).collect()) == 3


def test_a_wrong_index_fails(spark, tmp_path):
    from pyspark.errors import PySparkException
    from pyspark.sql import functions as F

    warc.write_monolithic(frame(spark), f"file://{tmp_path}/whole")
    index = warc.normalise(spark, f"file://{tmp_path}/whole", f"file://{tmp_path}/single")
    with pytest.raises(PySparkException, match="does not hold the record"):
        warc.read_records(index.withColumn("payload_bytes", F.col("payload_bytes") + 1), f"file://{tmp_path}/single").collect()


@pytest.mark.parametrize("size", [1, 7, 1 << 16])
def test_streams_in_any_pieces(size):
    record = lambda n, body: b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (n, body)
    records = [record(3, b"abc"), record(0, b""), record(8, b"\r\n\r\nWARC"), record(5000, b"x" * 5000)]
    for data in (gzip.compress(b"".join(records)), b"".join(map(warc.member, records))):
        cut = (data[i : i + size] for i in range(0, len(data), size))
        assert [r for _, _, r in warc.parse_records(cut)] == records
    with pytest.raises(ValueError, match="within a record"):
        list(warc.parse_records([gzip.compress(records[0][:-6])]))
    assert list(warc.parse_records([gzip.compress(b"")])) == []


def test_oracle_on_pages(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{h.SF}/pages.parquet'")
    assert order(warc.archived(h.pages(spark)).collect()) == order(con.execute(f"select page_id, payload_bytes, payload_digest, record_type, refers_to from ({warc.ORACLE})").fetchall())
    con.execute("drop view pages")
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", ROWS)
    assert order(con.execute(f"select page_id, payload_bytes, payload_digest, record_type, refers_to from ({warc.ORACLE})").fetchall()) == order(plain(ROWS))


def test_odd_rows(spark):
    df = frame(spark).selectExpr("*", "'x' as refers_to", "1 as payload_bytes", "2 as largest", "3 as value")
    assert order(warc.archived(df).collect()) == order(plain(ROWS))
    assert warc.archived(frame(spark, [])).collect() == []
    same = [(9, "u", "t"), (9, "u", "t"), (1, "v", "t")]
    assert order(warc.archived(frame(spark, same)).collect()) == order(plain(same))


def test_every_record_has_the_mandatory_headers(spark, tmp_path):
    """WARC 1.1: id, type, date and length in each record; a revisit names a response's id."""
    warc.write_monolithic(frame(spark).repartition(2), f"file://{tmp_path}/w", most=3)
    fields = [f for p in (tmp_path / "w").glob("*.gz") for f, _, _ in warc.parse_records([p.read_bytes()])]
    assert len(fields) == len(ROWS)
    for f in fields:
        assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", f["WARC-Record-ID"])
        assert f["WARC-Type"] in ("response", "revisit") and re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", f["WARC-Date"])
        assert f["Content-Length"].isdigit()
    assert len({f["WARC-Record-ID"] for f in fields}) == len(ROWS)
    ids = {f["WARC-Record-ID"]: f for f in fields}
    revisits = [f for f in fields if f["WARC-Type"] == "revisit"]
    assert revisits and all(ids[f["WARC-Refers-To"]]["X-Page-Id"] == f["X-Refers-To-Page-Id"] for f in revisits)
    assert not any("WARC-Refers-To" in f for f in fields if f["WARC-Type"] == "response")


def test_a_stream_of_large_records_needs_the_memory_of_few():
    size, n = 4 << 20, 12
    body = bytes(range(256)) * (size // 256)

    def pieces():
        z = zlib.compressobj(1, zlib.DEFLATED, 31)
        for i in range(n):
            yield z.compress(f"WARC/1.1\r\nWARC-Type: response\r\nX-Page-Id: {i}\r\nContent-Length: {size}\r\n\r\n".encode() + body + warc.END)
        yield z.flush()

    small = [p[i : i + warc.PIECE] for p in pieces() for i in range(0, len(p), warc.PIECE)]
    tracemalloc.start()
    seen = 0
    for fields, payload, record in warc.parse_records(small):
        assert int(fields["X-Page-Id"]) == seen and len(payload) == size
        seen += 1
        del payload, record
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == n and peak < 3 * size
