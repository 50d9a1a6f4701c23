import pytest

from orderflow.llm import warc


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_round_trip_with_segments(spark, folder, compression):
    pages = [
        (1, "http://a/", "WARC/1.1\r\nx\r\n\r\nWARC/1.1\r\nWARC/1.1" * 50),
        (2, None, None),
        (3, "a b\r\nc/WARC/1.1", ""),
        (4, "u", "é日本" * 3000),
        (5, "u", "é日本" * 3000),
        (5, "u", "é日本" * 3000),
        (7, "u", "x\r\n\r\n"),
        (8, "u", "0\r\n\r\n" * 100),
        (None, "u", "x\r\n\r\n"),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    warc.write(frame.selectExpr("*", "1 AS record", "2 AS sha"), folder("w"), segment_bytes=100, compression=compression)
    rows = warc.read(spark, folder("w")).collect()
    assert all(r["intact"] for r in rows) and len(rows) == len(pages)
    found = {r["page_id"]: r for r in rows}
    for page_id, _, html in pages:
        payload = (html or "").encode()
        assert found[page_id]["payload_bytes"] == len(payload)
        assert found[page_id]["payload_digest"] == warc.payload_digest(payload)
    assert {i: (r["record_type"], r["refers_to"]) for i, r in found.items()} == {
        1: ("response", None), 2: ("response", None), 3: ("revisit", 2), 4: ("response", None),
        5: ("revisit", 4), 7: ("response", None), 8: ("response", None), None: ("response", None),
    }
    assert bytes(found[4]["payload"]).decode() == "é日本" * 3000 and found[5]["payload"] is None


def test_rows_without_an_id_of_their_own_keep_their_segments(spark, folder):
    """Null ids, and repeated ids of one payload and of several, longer than a segment."""
    pages = [(None, "u", f"{i} " * 500) for i in range(5)] + [(None, "u", "same" * 300)] * 2
    pages += [(1, "u", "same" * 300)] * 3 + [(2, "u", "same" * 300)] * 2
    pages += [(3, "u", "one " * 300), (3, "u", "other " * 300)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    warc.write(frame, folder("w"), segment_bytes=100)
    rows = warc.read(spark, folder("w")).collect()
    assert all(r["intact"] for r in rows)
    revisit = (2, "revisit", 1, None)
    wanted = [revisit if i == 2 else (i, "response", None, html) for i, _, html in pages]
    found = [(r["page_id"], r["record_type"], r["refers_to"], r["payload"] and bytes(r["payload"]).decode()) for r in rows]
    assert sorted(found, key=str) == sorted(wanted, key=str)
    ids = [r["record_id"] for r in warc.parsed(spark, folder("w")).collect()]
    assert len(set(ids)) == len(ids)


def test_no_record_is_missed_at_the_end_of_a_buffer(spark, folder):
    """Every length of text before a mark, so that marks fall on all places of read buffers."""
    pages = [(i, "u", "x" * (i % 211) + "\r\n\r\n" * (i % 7)) for i in range(6000)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    for compression in ("none", "gzip"):
        warc.write(frame, folder(compression), compression=compression)
        rows = warc.read(spark, folder(compression)).collect()
        assert sorted(r["page_id"] for r in rows) == list(range(6000))
        assert all(r["intact"] for r in rows)


def test_small_payloads_may_be_stored_again(spark, folder):
    frame = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    warc.write(frame, folder("w"), least_revisit_bytes=3)
    assert {r["page_id"]: r["refers_to"] for r in warc.read(spark, folder("w")).collect()} == {1: None, 2: None, 3: None, 4: 3}
    warc.write(frame.limit(0), folder("empty"))
    assert warc.read(spark, folder("empty")).collect() == []


def test_what_is_broken_is_told(spark, folder):
    """Segments lost, repeated or of another total length, wrong framing, a wrong digest."""
    records = [r for i in range(1, 8) for r in warc.records(i, "u", b"payload %d" % i * 20, None, "d", 120)]
    assert len(records) == 21

    def of(page, segment):
        return records[3 * (page - 1) + segment - 1]

    records = (
        [of(1, 1), of(1, 2), of(1, 3)]
        + [of(2, 1), of(2, 3)]
        + [of(3, 1), of(3, 2), of(3, 2), of(3, 3)]
        + [of(4, 1), of(4, 2), of(4, 3).replace(b"Total-Length: 2", b"Total-Length: 9")]
        + [of(5, 2), of(5, 3)]
        + [of(6, 1).replace(b"\r\nb4\r\n", b"\r\nbx\r\n"), of(6, 2), of(6, 3)]
        + [of(7, 1).replace(b"payload 7", b"payl0ad 7"), of(7, 2), of(7, 3)]
    )
    lines = spark.createDataFrame([(bytearray(r),) for r in records], "b binary").selectExpr("cast(b AS string) AS value")
    lines.write.option("lineSep", warc.BETWEEN).text(folder("w"))
    found = {r["page_id"]: r for r in warc.read(spark, folder("w")).collect()}
    assert {i: r["intact"] for i, r in found.items()} == {1: True, 2: False, 3: False, 4: False, 5: False, 6: False, 7: False}
    assert found[5]["record_type"] == "continuation"


def test_chunked_framing():
    for payload in (b"", b"x", b"WARC/1.1" * 3, bytes(range(256)) * 100):
        framed = warc.chunked(payload)
        assert warc.unchunked(framed) == payload and warc.VERSION not in framed
    assert warc.unchunked(b"3;ext=1\r\nabc\r\n0\r\ntrailer: 1\r\n\r\n") == b"abc"
    for broken in (b"", b"3\r\nab", b"zz\r\nab\r\n0\r\n\r\n", b"2\r\nabc\r\n0\r\n\r\n"):
        assert warc.unchunked(broken) is None


def test_header_bytes_that_are_not_utf8(spark, tmp_path):
    record = b"WARC/1.1\r\nWARC-Type: resp\xf6nse\r\nWARC-Record-ID: <urn:page:5>\r\nContent-Length: \xb2\r\n\r\nblock\r\n\r\n"
    (tmp_path / "odd.warc").write_bytes(record)
    (row,) = warc.parsed(spark, str(tmp_path)).collect()
    assert row["type"] == "resp\xf6nse" and not row["whole"]
