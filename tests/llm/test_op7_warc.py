import hashlib
import struct

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_util import SF, folder, rows

from segmint.llm import op7_warc as M


DATE = "2024-05-06T07:08:09Z"


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=300), st.one_of(st.none(), st.text(st.characters(exclude_categories=["Cs"]), max_size=20)),
       st.one_of(st.none(), st.integers(0, 99)), st.one_of(st.none(), st.integers(0, 99)))
def test_records_round_trip(payload, url, page, refers):
    d = hashlib.sha1(payload).hexdigest()
    got = M.parse(M.record("urn:x:1", DATE, page, url, payload, d, refers, url))
    assert (got["page_id"], got["payload_bytes"], got["payload_digest"], got["refers_to"]) == (page, len(payload), d, refers)
    assert got["payload"] == (payload if refers is None else None) and got["record_id"] == "urn:x:1"
    assert got["url"] == (None if url is None else url.replace("\r", "%0D").replace("\n", "%0A"))


def strict(data):
    """Records (headers, block) of a WARC file by the rules of the standard:
    version line, fields, an empty line, Content-Length bytes, two line ends."""
    out = []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        assert version == "WARC/1.1"
        fields = dict(x.split(": ", 1) for x in lines)
        assert len(fields) == len(lines)
        n = int(fields["Content-Length"])
        assert rest[n : n + 4] == b"\r\n\r\n"
        out.append((fields, rest[:n]))
        data = rest[n + 4 :]
    return out


def test_archives_are_valid_warc(spark):
    big = "x" * 1000
    pages = [(1, "http://h/1", big), (2, None, big), (2, None, big), (3, "http://h/3", "small"), (None, None, None), (3, "http://h/3", "small"),
             (4, "http://h/4\r\nX: y", big)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(2)
    bundles = M.write_bundles(M.decisions(df), DATE).collect()
    got = []
    for b in bundles:
        reader = zstandard.ZstdDecompressor().stream_reader(bytes(b.data), read_across_frames=True)
        records = strict(reader.read())
        assert [e.record_id for e in b.entries] == [f["WARC-Record-ID"][1:-1] for f, _ in records]
        got += records
    assert len(got) == len(pages)
    assert len({f["WARC-Record-ID"] for f, _ in got}) == len(pages)
    assert all(f["WARC-Record-ID"].startswith("<urn:uuid:") and f["WARC-Date"] == DATE and f["WARC-Target-URI"] for f, _ in got)
    for f, block in got:
        if f["WARC-Type"] == "revisit":
            assert not block and f["WARC-Profile"] == M.PROFILE
            assert f["WARC-Refers-To-Target-URI"] == "http://h/4%0D%0AX: y" and f["WARC-Refers-To-Date"] == DATE
        else:
            assert f["Content-Type"] == "application/http; msgtype=response"
            http, _, body = block.partition(b"\r\n\r\n")
            assert http.startswith(b"HTTP/1.1 200 OK\r\n") and f"Content-Length: {len(body)}".encode() in http
            assert f["WARC-Payload-Digest"] == "sha1:" + hashlib.sha1(body).hexdigest()
    assert sum(f["WARC-Type"] == "revisit" for f, _ in got) == 3


def test_bundles_are_seekable_and_plain_zstd():
    w = M.BundleWriter()
    recs = [(i, bytes([i]) * (70_000 + i)) for i in range(12)]
    for i, r in recs:
        w.add(i, f"urn:x:{i}", r)
    b = w.close()
    table = M.seek_table(b["data"])
    assert len(table) > 3
    for e, (i, r) in zip(b["entries"], recs, strict=True):
        frame = M.read_frame(b["data"], table[e["frame"]])
        assert frame[e["offset"] : e["offset"] + e["length"]] == r and e["page_id"] == i
    reader = zstandard.ZstdDecompressor().stream_reader(b["data"], read_across_frames=True)
    assert reader.read() == b"".join(r for _, r in recs)  # skippable frames are skipped
    assert struct.unpack("<I", b["data"][-4:])[0] == M.SEEKABLE
    with pytest.raises(ValueError):
        M.seek_table(b["data"][:-1] + b"x")


def plain(pages):
    top = {}
    for p, h in pages:
        b = (h or "").encode()
        if len(b) >= 1000 and p is not None:
            top[b] = max(top.get(b, p), p)
    out = []
    for p, h in pages:
        b = (h or "").encode()
        t = top.get(b)
        rev = t is not None and p != t
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if rev else "response", t if rev else None))
    return sorted(out, key=str)


def result(spark, sf):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in rows(M.q_op7(spark, sf))), key=str)


def test_edges(spark, empty):
    big, é = "x" * 1000, "é" * 500
    pages = [(1, big), (2, big), (3, big), (4, é), (5, é), (6, "x" * 999), (7, "x" * 999), (8, None), (9, ""), (3, big),
             (None, "a"), (None, big), (10, "y" * 3_000_000), (11, "tab\r\n\r\nWARC/1.1\r\n")]
    sf = folder(spark, pages=[(p, None if p == 8 else f"http://h/{p}\r\nX: y", h, "clash") for p, h in pages])
    assert result(spark, sf) == plain(pages)
    assert result(spark, empty) == []


def test_many_copies(spark):
    pages = [(i, "same page " * 200 if i % 3 == 0 else f"page {i} " * 200) for i in range(900)]
    sf = folder(spark, pages=[(p, "u", h, "d") for p, h in pages])
    assert result(spark, sf) == plain(pages)


def test_sample_and_fetch(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert result(spark, SF) == plain(pages)
    bundles = M.write_bundles(M.decisions(spark.read.parquet(f"{SF}/pages.parquet")))
    got = {r["page_id"]: r["payload"] for r in rows(M.fetch(bundles, spark.createDataFrame([(3,), (7,), (10**9,)], "page_id long")))}
    assert set(got) == {3, 7} and all(bytes(v).decode() == dict(pages)[k] for k, v in got.items())


def test_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    want = sorted(((a, b, c, d, e) for a, b, c, d, e in con.execute(M.SQL_OP7).fetchall()), key=str)
    assert result(spark, SF) == want
