"""Archives: exact round trip, revisits, assembly through concurrent-to identifiers."""

import gzip
import hashlib
import tracemalloc

import pytest

from flowsift.llm import warc

SCHEMA = "page_id long, url string, html string, uri string"


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA)


def test_round_trip_with_revisits(spark):
    same = "é" * 600
    rows = [
        (1, "http://a/", same),
        (9, "http://b/", same),
        (5, None, same),
        (None, "http://c/", same),
        (2, "http://d/", "short"),
        (3, "http://e/", "short"),
        (4, "http://f/", None),
        (6, "http://g/\r\nX: y", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 200),
        (7, "http://h/", ""),
        (9, "http://b/", same),
    ]
    got = warc.archive_round_trip(_pages(spark, rows), with_payload=True).collect()
    assert sorted(str(r.page_id) for r in got) == sorted(str(r[0]) for r in rows)
    first = [r for r in got if r.page_id == 9 and r.response.type == "response"]
    assert len(first) == 1
    for r in got:
        body = next((x[2] or "" for x in rows if x[0] == r.page_id)).encode()
        assert r.response.payload_bytes == len(body)
        assert r.response.payload_digest == hashlib.sha1(body).hexdigest()
        assert r.n_requests == r.n_metadata == 1
        if r.response.type == "revisit":
            assert r.response.refers_to == first[0].capture_id and r.page_id in (1, 5, 9, None)
        else:
            assert bytes(r.response.payload) == body
    assert sum(r.response.type == "revisit" for r in got) == 4


def test_parts_without_partners(spark):
    rows = [
        ("<m>", "metadata", ["<q>"]),
        ("<q>", "request", ["<r>"]),
        ("<r>", "response", []),
        ("<lone>", "request", ["<gone>"]),
        ("<z>", "request", ["<r>"]),
        ("<free>", "metadata", []),
    ]
    schema = warc.RECORD
    full = [(a, b, c, None, None, 1, 1, "d", [], None) for a, b, c in rows]
    got = {r.capture_id: r for r in warc.assemble(spark.createDataFrame(full, schema)).collect()}
    assert set(got) == {"<r>", "<gone>", "<free>"}
    assert [x.record_id for x in got["<r>"].requests] == ["<q>", "<z>"] and got["<r>"].n_requests == 2
    assert [x.record_id for x in got["<r>"].metadata] == ["<m>"] and got["<free>"].requests == []
    assert got["<gone>"].response is None and got["<free>"].response is None


def test_all_null_ids_and_empty_table(spark):
    got = warc.archive_round_trip(_pages(spark, [(None, None, "x" * 2000)] * 3)).collect()
    assert [r.response.type for r in got] == ["response"] * 3
    assert warc.archive_round_trip(_pages(spark, [])).count() == 0


def test_all_metadata_records_of_a_capture_are_kept(spark):
    rows = [("<r>", "response", [])] + [(f"<m{i:03d}>", "metadata", ["<r>"]) for i in range(300)]
    full = [(a, b, c, None, None, 1, 1, "d", [("k", a)], b"x") for a, b, c in rows]
    row = warc.assemble(spark.createDataFrame(full, warc.RECORD).repartition(7)).first()
    assert [x.record_id for x in row.metadata] == sorted(r[0] for r in rows[1:]) and row.n_metadata == 300
    assert [x.fields[0].value for x in row.metadata] == [x.record_id for x in row.metadata]


def _record(number, body):
    return b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (number, len(body), body)


def test_archives_of_members_are_read_as_a_stream():
    bodies = [bytes([65 + i % 26]) * (i * 977 % 70_000) for i in range(200)] + [b"\r\n" * 5000, b"WARC/1.1\r\n\r\n", b""]
    plain = b"".join(_record(i, b) for i, b in enumerate(bodies))
    by_record = b"".join(gzip.compress(_record(i, b)) for i, b in enumerate(bodies))
    for content in (plain, gzip.compress(plain), by_record):
        assert [r["payload"] for r in warc.records_of(content)] == bodies
    for broken in (plain[:-700], by_record[:-30], gzip.compress(plain)[:-9], b"nonsense\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.records_of(broken))


def test_no_more_than_a_record_is_held():
    content = gzip.compress(_record(0, b"\0" * (300 << 20)) + b"".join(_record(i, b"\0" * (1 << 20)) for i in range(1, 200)))
    rest = warc._unpacked(content)
    assert max(map(len, rest)) <= 4 << 20
    content = gzip.compress(b"".join(_record(i, b"\0" * (1 << 20)) for i in range(200)))
    tracemalloc.start()
    assert sum(len(r["payload"]) for r in warc.records_of(content)) == 200 << 20
    assert tracemalloc.get_traced_memory()[1] < 40 << 20
    tracemalloc.stop()
