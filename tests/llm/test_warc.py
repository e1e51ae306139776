"""WARC: what is written comes back; framing, digests and damage."""

import hashlib
import zlib

import corpus
import pytest

from catalog.check import connection, difference
from regionscore.llm import warc
from regionscore.llm.queries import ORACLE, QUERIES

SCHEMA = "page_id bigint, url string, html string, digest string, revisit int, first string, n bigint"
BIG = "<p>" + corpus.sentence(1, 400) + "é🙂</p>"


def rows():
    data = [(1, "http://a/", BIG), (2, None, BIG), (9, "http://b/\r\nx", BIG), (9, "http://b/2", BIG), (None, "http://c/", BIG), (3, "http://d/", "small"), (4, "http://d/", "small"),
            (5, "http://e/", None), (6, "http://e/", ""), (7, "http://f/", "WARC/1.1\r\n\r\n" * 200), (None, None, "z" * 2000), (None, None, "z" * 2000), (8, "u", "y" * 3_000_000)]
    return [(*r, "d", 1, "f", 2) for r in data]


def test_come_back(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 3000)
    monkeypatch.setattr(warc, "PIECE_BYTES", 100)
    got = warc.read(warc.write(spark.createDataFrame(rows(), SCHEMA))).filter("record_type <> 'warcinfo'").collect()
    assert len(got) == len(rows()) and all(r["valid"] for r in got)
    kinds = sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in got if r["page_id"] is not None)
    assert kinds == [(1, "revisit", 9), (2, "revisit", 9), (3, "response", None), (4, "response", None), (5, "response", None), (6, "response", None),
                     (7, "response", None), (8, "response", None), (9, "response", None), (9, "response", None)]
    assert sorted((r["record_type"], r["refers_to"] or 0) for r in got if r["page_id"] is None) == [("response", 0), ("response", 0), ("revisit", 9)]
    texts = {r[0]: (r[2] or "").encode() for r in rows()}
    for r in got:
        if r["page_id"] is not None:
            full = texts[r["page_id"]]
            assert (r["payload_bytes"], r["payload_digest"]) == (len(full), hashlib.sha1(full).hexdigest())
            assert bytes(r["payload"]) == (full if r["record_type"] == "response" else b"")
    assert {r["url"] for r in got if r["page_id"] == 9} == {"http://b/ x", "http://b/2"}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    sf = f"/root/testdata/{sf}"
    assert difference(QUERIES["op8_warc"](spark, sf), connection(sf), ORACLE["op8_warc"]) is None


def test_empty_table(spark):
    assert warc.read(warc.write(spark.createDataFrame([], SCHEMA))).count() == 0


def test_one_member_for_each_record():
    data = b"".join(warc.page_record(i, "u", "x" * i * 100, None, False, "2024-01-01T00:00:00Z") for i in range(5))
    members = 0
    while data:
        packer = zlib.decompressobj(31)
        text = packer.decompress(data)
        assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n") and packer.eof
        data, members = packer.unused_data, members + 1
    assert members == 5


@pytest.mark.parametrize("piece", [1, 7, 1000, 10**9])
def test_pieces_do_not_show(piece):
    data = b"".join(warc.page_record(i, "u", corpus.sentence(i, 30 * i), None, False, "2024-01-01T00:00:00Z") for i in range(6))
    got = [r.payload.decode() for r in warc.records(data[a:a + piece] for a in range(0, len(data), piece))]
    assert got == [corpus.sentence(i, 30 * i) for i in range(6)]


def test_wrong_digests_and_damage():
    good = warc.page_record(1, "u", "text", None, False, "2024-01-01T00:00:00Z")
    plain = zlib.decompress(good, 31)
    pack = lambda x: (lambda p: p.compress(x) + p.flush())(zlib.compressobj(6, zlib.DEFLATED, 31))
    assert [r.valid for r in warc.records([pack(plain), pack(plain.replace(b"\r\n\r\ntext", b"\r\n\r\ntexT"))])] == [True, False]
    for bad in (good[:-12], good[:40], pack(plain[:-20])):
        with pytest.raises(ValueError):
            list(warc.records([bad]))
    with pytest.raises(ValueError):
        list(warc.records([pack(b"no record\r\n")]))


def test_other_writers_digests_and_files(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\n\r\npayload"
    one = warc.record("response", [("WARC-Record-ID", "<urn:uuid:1>"), ("Content-Type", "application/http; msgtype=response"),
                                   ("WARC-Payload-Digest", "sha1:" + hashlib.sha1(b"payload").hexdigest())], block, "2024-01-01T00:00:00Z")
    two = warc.record("metadata", [("WARC-Record-ID", "<urn:uuid:2>"), ("WARC-Payload-Digest", "md5:00")], b"x: y", "2024-01-01T00:00:00Z")
    (tmp_path / "a.warc.gz").write_bytes(one + two)
    got = warc.read(warc.archive_files(spark, str(tmp_path))).orderBy("record_type").collect()
    assert [(r["record_type"], bytes(r["payload"]), r["valid"], r["page_id"]) for r in got] == [("metadata", b"x: y", True, None), ("response", b"payload", True, None)]
