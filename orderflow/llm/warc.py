"""WARC archives of pages: writing, and reading with segments put together (operator 6).

A page is a response record with chunked transfer framing, or a revisit record if a page of a
smaller id has the same payload. A block longer than segment_bytes is cut: the first segment is
in the record itself, the others are continuation records that name it as their origin, and the
last of them tells the length of all. The reader groups segments by origin, orders them by
number, compares the length, and undoes the framing. Records are named by page and digest, and
by a number drawn for the row where these do not tell rows apart.

Archives are written and read as Spark text whose lines are records, so a reading task holds a
record at a time and plain files are split among tasks. The mark at which a reader cuts cannot
occur within a block: the framing cuts the version string wherever a payload has it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm.common import map_batches
from orderflow.llm.words import slices

VERSION = b"WARC/1.1"
BETWEEN = "\r\n\r\n"
CHUNK_BYTES = 4096
SEGMENT_BYTES = 1 << 20
# Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes) -> bytes:
    """Chunked transfer framing; the version string never stays whole."""
    cuts = set(range(0, len(payload), CHUNK_BYTES)) | {len(payload)}
    cuts |= {match.start() + 4 for match in re.finditer(re.escape(VERSION), payload)}
    places = sorted(cuts)
    parts = [payload[a:b] for a, b in zip(places, places[1:])]
    return b"".join(b"%x\r\n%b\r\n" % (len(part), part) for part in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body, trailers aside; None if the framing is broken."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = re.fullmatch(rb"[0-9A-Fa-f]+", body[at : max(at, end)].split(b";")[0].strip())
        if end < 0 or not size:
            return None
        n = int(size[0], 16)
        if not n:
            return b"".join(parts)
        part = body[end + 2 : end + 2 + n]
        if len(part) < n or body[end + 2 + n : end + 4 + n] != b"\r\n":
            return None
        parts.append(part)
        at = end + 4 + n


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers if value is not None)
    return b"%b\r\n%bContent-Length: %d\r\n\r\n%b" % (VERSION, lines.encode(), len(block), block)


def _plain(url: str) -> str:
    """Without white space, control characters and the mark at which a reader cuts."""
    return re.sub(r"[\x00-\x20\x7f]", "%20", url).replace(VERSION.decode(), "%57ARC/1.1")


def _urn(page_id: int | None, digest: str, drawn: str | None = None, segment: int = 1) -> str:
    own = f":{drawn}" if drawn else ""
    part = "" if segment == 1 else f":{segment}"
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}{own}{part}>"


def records(
    page_id: int | None,
    url: str,
    payload: bytes,
    refers_to: int | None,
    date: str,
    segment_bytes: int,
    drawn: str | None = None,
) -> Iterator[bytes]:
    """The record of a page and its continuations; refers_to makes it a revisit. drawn tells
    apart rows of one page and payload."""
    revisit = refers_to is not None
    digest = payload_digest(payload)
    name = _urn(page_id, digest, drawn)
    if revisit:
        block = f"{HTTP_HEAD}Content-Length: {len(payload)}\r\n\r\n".encode()
    else:
        block = f"{HTTP_HEAD}Transfer-Encoding: chunked\r\n\r\n".encode() + chunked(payload)
    parts = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    cut = len(parts) > 1
    yield _record(
        [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", name),
            ("WARC-Date", date),
            ("WARC-Target-URI", _plain(url)),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("WARC-Profile", REVISIT_PROFILE if revisit else None),
            ("WARC-Refers-To", _urn(refers_to, digest) if revisit else None),
            ("WARC-Segment-Number", 1 if cut else None),
            ("Content-Type", "application/http; msgtype=response"),
        ],
        parts[0],
    )
    for number, part in enumerate(parts[1:], 2):
        yield _record(
            [
                ("WARC-Type", "continuation"),
                ("WARC-Record-ID", _urn(page_id, digest, drawn, number)),
                ("WARC-Date", date),
                ("WARC-Segment-Origin-ID", name),
                ("WARC-Segment-Number", number),
                ("WARC-Segment-Total-Length", len(block) if number == len(parts) else None),
            ],
            part,
        )


def write(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_revisit_bytes: int = 0,
    segment_bytes: int = SEGMENT_BYTES,
    date: str = "2024-01-01T00:00:00Z",
    compression: str = "gzip",
) -> None:
    """Writes archives below path.

    Of pages with equal payloads of least_revisit_bytes or more, the one with the smallest id is
    a response and the others are revisits that refer to it. A null payload is empty, a null url
    too; a page without an id is always a response; rows that repeat a page and its payload are
    all of its kind, each with a record id of its own; other columns are left out. A revisit
    refers to page and digest: the id of the response, or what the ids of repeated ones begin with.
    """
    rows = pages.select(
        pages[id_col].cast("long").alias("page_id"),
        F.coalesce(pages[url_col].cast("string"), F.lit("")).alias("url"),
        F.coalesce(pages[payload_col].cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("sha", F.sha1("payload"))
    # Only ids and digests are grouped, so a payload that very many pages have is no hot spot.
    seen = rows.groupBy("page_id", "sha").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.octet_length("payload")).alias("bytes")
    )
    long_enough = seen.where(F.col("bytes") >= least_revisit_bytes)
    first = long_enough.groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("ids"))
    told = seen.join(first.where("ids > 1").drop("ids"), "sha", "left").select(
        "page_id", "sha", F.expr("CASE WHEN page_id > first THEN first END AS refers_to"), F.expr("n > 1 AS repeated")
    )
    rows = rows.join(told.where("refers_to IS NOT NULL OR repeated"), ["page_id", "sha"], "left")
    rows = rows.withColumn("drawn", F.expr("page_id IS NULL OR coalesce(repeated, false)"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part in slices(batch, "payload"):
                out = [
                    record
                    for p in part.to_pylist()
                    for record in records(
                        p["page_id"], p["url"], p["payload"], p["refers_to"], date, segment_bytes,
                        uuid.uuid4().hex if p["drawn"] else None,
                    )
                ]
                yield {"record": out}

    out = map_batches(rows.select("page_id", "url", "payload", "refers_to", "drawn"), run, "record binary")
    # A cast from binary to string keeps the bytes as they are, also half a character.
    lines = out.select(F.col("record").cast("string").alias("value"))
    lines.write.option("lineSep", BETWEEN).option("compression", compression).text(path)


_PARTS = (
    "record_id string, type string, refers_to string, digest string, origin string, number int, "
    "total long, whole boolean, block binary"
)


def parsed(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record of the archives below path, segments apart. whole says whether the
    block has the length that its header tells."""
    # The mark begins with a byte that it does not hold again, so a reader that meets its beginning
    # at the end of a buffer cannot miss it. Each file begins with it: before it is nothing.
    lines = spark.read.option("lineSep", f"{VERSION.decode()}\r\n").text(path).where("value <> ''")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        names = [field.split()[0] for field in _PARTS.split(", ")]
        for batch in batches:
            rows = [_fields(record) for record in batch["value"].to_pylist()]
            yield dict(zip(names, zip(*rows))) if rows else {name: [] for name in names}

    return map_batches(lines.select(F.col("value").cast("binary").alias("value")), run, _PARTS)


def _fields(record: bytes) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = (line.partition(b":") for line in head.split(b"\r\n"))
    # Header fields are Latin-1 at worst: every byte has a character there.
    headers = {name.strip().lower().decode("latin-1"): value.strip().decode("latin-1") for name, _, value in lines}

    def number(name: str) -> int | None:
        value = headers.get(name, "")
        return int(value) if value.isascii() and value.isdigit() else None

    length = number("content-length")
    block = rest[:length] if length is not None else rest
    return (
        headers.get("warc-record-id"),
        headers.get("warc-type"),
        headers.get("warc-refers-to"),
        headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        headers.get("warc-segment-origin-id"),
        number("warc-segment-number"),
        number("warc-segment-total-length"),
        length == len(block),
        block,
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """page_id, record_type, refers_to, payload_digest, payload_bytes, payload (null in a
    revisit), intact: one row for each page below path.

    Only segments are shuffled, by their origin. A record whose segments are missing, repeated
    or of another total length, whose framing is broken or whose payload has another digest, is
    not intact; without a payload that can be told it has a null one. Continuations whose origin
    is missing give a row of record_type continuation.
    """
    found = parsed(spark, path)
    single = found.where("number is null").select(
        "record_id", "type", "refers_to", "digest", F.array(F.struct("number", "total", "whole", "block")).alias("parts")
    )
    part = F.struct("number", "total", "whole", "block")
    head = F.col("origin").isNull()
    cut = (
        found.where("number is not null")
        .groupBy(F.coalesce("origin", "record_id").alias("record_id"))
        .agg(
            F.coalesce(F.max(F.when(head, F.col("type"))), F.lit("continuation")).alias("type"),
            F.max(F.when(head, F.col("refers_to"))).alias("refers_to"),
            F.max(F.when(head, F.col("digest"))).alias("digest"),
            F.array_sort(F.collect_list(part)).alias("parts"),
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        names = [field.split()[0] for field in schema.split(", ")]
        for batch in batches:
            rows = [_page(row) for row in batch.to_pylist()]
            yield dict(zip(names, zip(*rows))) if rows else {name: [] for name in names}

    schema = (
        "page_id long, record_type string, refers_to long, payload_digest string, "
        "payload_bytes long, payload binary, intact boolean"
    )
    return map_batches(single.unionByName(cut), run, schema)


def _page(row: dict) -> tuple:
    parts = row["parts"]
    block = b"".join(part["block"] for part in parts)
    numbers = [part["number"] for part in parts]
    complete = all(part["whole"] for part in parts) and (
        numbers == [None]
        or numbers == list(range(1, len(parts) + 1)) and parts[-1]["total"] == len(block)
    )
    head, _, body = block.partition(b"\r\n\r\n")
    page_id, refers_to = _page_id(row["record_id"]), _page_id(row["refers_to"])
    kept = page_id, row["type"], refers_to, row["digest"]
    if row["type"] == "revisit":
        length = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", head)
        return (*kept, int(length[1]) if length else None, None, complete and bool(length))
    if re.search(rb"(?i)\r\ntransfer-encoding:\s*chunked", head):
        payload = unchunked(body) if complete else None
    else:
        payload = body if complete else None
    if payload is None:
        return (*kept, None, None, False)
    return (*kept, len(payload), payload, payload_digest(payload) == row["digest"])


def _page_id(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)(:\w+)*>", urn or "")
    return int(found[1]) if found else None
