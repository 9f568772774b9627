"""Archives of pages: deduplicated by payload, read back record by record."""

from __future__ import annotations

import gzip
import hashlib
from pathlib import Path

import pytest

from oracle import connect, differences
from shelfwise.llm import queries, warc


def test_query_equals_sql(spark, small):
    assert differences(queries.QUERIES["op13_warc"](spark, small), connect(small), queries.ORACLE_SQL["op13_warc"]) is None


BIG = "<p>" + "payload " * 30 + "</p>"
AWKWARD = [
    (3, "http://a.example/x", BIG), (1, "http://a.example/first\r\nWARC-Type: revisit", BIG), (1, "http://a.example/again", BIG),
    (None, "http://a.example/null", BIG), (None, None, None), (4, None, ""), (5, "u", "short"), (6, "u", "short"),
    (7, "ü b\t", "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\n" + "é\n\r\r\n" * 50),
    (8, "u", "z" * 99), (9, "u", "z" * 99), (10, "u", "y" * 100), (11, "u", "y" * 100), (12, "u", "é" * 50), (12, "u", "é" * 50),
    (13, "u", "\n\n\n"), (14, "u", "long " * 300_000),
]


def frame(spark, rows):
    names = "page_id long, url string, html string, file string, at string, digest string, first string, value string"
    return spark.createDataFrame([(*r, "f", "a", "d", "1", "v") for r in rows], names)


def brute_force(rows):
    """Sorted (page_id, bytes, digest, type, refers_to)."""
    out = []
    first: dict[str, tuple] = {}
    for k, (i, _, html) in sorted(enumerate(rows), key=lambda x: (x[1][0] is None, x[1][0] or 0, x[0])):
        raw = (html or "").encode()
        digest = hashlib.sha256(raw).hexdigest()
        if len(raw) >= 100 and digest in first:
            out.append((i, len(raw), digest, "revisit", first[digest][0]))
        else:
            first.setdefault(digest, (i,))
            out.append((i, len(raw), digest, "response", None))
    return sorted(out, key=str)


def test_awkward_pages_equal_brute_force(spark):
    rows = warc.report(frame(spark, AWKWARD)).collect()
    assert sorted((tuple(r) for r in rows), key=str) == brute_force(AWKWARD)
    assert warc.report(frame(spark, AWKWARD).limit(0)).count() == 0


def test_payloads_come_back_and_are_kept_once(spark, tmp_path):
    path = str(tmp_path / "archives")
    warc.write(frame(spark, AWKWARD).repartition(3), path)
    records = warc.read(spark, path).collect()
    assert len(records) == len(AWKWARD)
    responses = [r for r in records if r["record_type"] == "response"]
    assert sorted(bytes(r["payload"]) for r in responses if r["page_id"] == "7") == [AWKWARD[8][2].encode()]
    assert sum(bytes(r["payload"]) == BIG.encode() for r in responses) == 1
    ids = {r["record_id"]: r for r in responses}
    assert len({r["record_id"] for r in records}) == len(records)
    for r in records:
        if r["record_type"] == "revisit":
            assert not r["payload"] and ids[r["refers_to"]]["payload_digest"] == r["payload_digest"]
            assert r["refers_to_uri"] == ids[r["refers_to"]]["target_uri"]
    injected = [r for r in records if r["page_id"] == "1" and "first" in r["target_uri"]]
    assert [r["target_uri"] for r in injected] == ["http://a.example/first%0D%0AWARC-Type:%20revisit"]


def test_archives_are_plain_records(spark, tmp_path):
    path = tmp_path / "archives"
    warc.write(frame(spark, AWKWARD[:1]), str(path))
    (file,) = [f for f in Path(path).glob("part-*") if gzip.open(f).read()]
    raw = gzip.open(file).read()
    head, rest = raw.split(b"\r\n\r\n", 1)
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    assert head.startswith(b"WARC/1.1\r\n") and fields[b"WARC-Type"] == b"response"
    assert rest[int(fields[b"Content-Length"]) :] == b"\r\n\r\n" and rest.endswith(BIG.encode() + b"\r\n\r\n")


def test_records_do_not_depend_on_the_cuts_of_the_stream():
    raw = b"".join(
        b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block)
        for block in (b"", b"abc", b"\r\n\r\n", b"WARC/1.0\r\n\r\n" * 5)
    )
    whole = list(warc.records_in(iter([raw])))
    assert [b for _, b in whole] == [b"", b"abc", b"\r\n\r\n", b"WARC/1.0\r\n\r\n" * 5]
    for n in (1, 2, 7, 50):
        assert list(warc.records_in(iter([raw[i : i + n] for i in range(0, len(raw), n)]))) == whole
    with pytest.raises(ValueError, match="cut off"):
        list(warc.records_in(iter([raw[:-10]])))
    with pytest.raises(ValueError, match="not a WARC record"):
        list(warc.records_in(iter([b"HTTP/1.1 200 OK\r\n\r\n"])))
