"""WARC archives: writing captures, reading records, and assembling transactions through concurrent-to identifiers.

A capture is written as three records (request, response or revisit, metadata) by Spark's own text sink, so the commit protocol
covers lost executors and any Hadoop file system will do. Archives are read file by file: the writer sizes its files by
`FILE_BYTES`, which bounds what a reading task holds.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.session import materialize, scratch_path

#: Payloads shorter than this are written in full every time.
REVISIT_FROM = 1000
#: Bytes of payload that a written file holds on average.
FILE_BYTES = 24 << 20
# Names of the standard.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


def _urn(kind: str, number: Column) -> Column:
    """A record id drawn from the row's number in the written table."""
    h = F.md5(F.concat(F.lit(kind), number))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind: Column, fields: list[tuple[str, Column]], block: Column) -> Column:
    """Header and block; a field whose value is null is left out."""
    named = [("WARC-Type", kind), *fields, ("Content-Length", F.octet_length(block).cast("string"))]
    lines = F.concat_ws("\r\n", F.lit(VERSION), *[F.concat(F.lit(name + ": "), value) for name, value in named])
    return F.concat(lines, F.lit(END), block)


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> None:
    """Write one capture per row to `path` (gzip files of about `FILE_BYTES` of payload).

    Of rows with equal payloads of `REVISIT_FROM` bytes or more, that with the largest id is a response and the others revisits
    of it (of repeated rows with that id, one is the response); all shorter ones are responses. A null body is an empty payload,
    a null url is left out. Rows without an id count as smaller than any other, and are all responses where no row of the group
    has an id. An empty table gives a folder without records.
    """
    line = F.regexp_replace(F.col(url_col), r"[\r\n]", "")
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), line.alias("url"), F.coalesce(F.col(body_col), F.lit("")).alias("body")
    )
    rows = rows.withColumns(
        {"size": F.octet_length("body"), "digest": F.sha1("body"), "number": F.monotonically_increasing_id()}
    )
    # numbers are fixed by writing them: an id must not change between a record and those that name it
    rows = materialize(rows, "pages")
    long = rows.where(F.col("size") >= REVISIT_FROM)
    many = long.groupBy("digest").agg(F.max(F.struct("id", "number")).alias("first"), F.count("*").alias("n"))
    many = materialize(many.where("n > 1 and first.id is not null").select("digest", "first"), "repeated")
    extent = rows.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first()
    per_file = max(16, int((extent["n"] or 1) * FILE_BYTES / max(1, extent["bytes"] or 1)))
    told = rows.join(many, (rows["digest"] == many["digest"]) & (rows["size"] >= REVISIT_FROM), "left").drop(many["digest"])
    told = told.withColumn("again", F.col("first").isNotNull() & (F.col("number") != F.col("first.number")))
    own = F.col("number").cast("string")
    mine = F.when(F.col("again"), _urn("revisit", own)).otherwise(_urn("response", own))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(END)
    )
    uri = ("WARC-Target-URI", F.col("url"))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    to = ("WARC-Concurrent-To", mine)
    http = ("Content-Type", F.lit("application/http; msgtype=response"))
    records = [
        _record(
            F.lit("request"),
            [("WARC-Record-ID", _urn("request", own)), to, uri, ("Content-Type", F.lit("application/http; msgtype=request"))],
            F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(" HTTP/1.1" + END)),
        ),
        _record(
            F.when(F.col("again"), F.lit("revisit")).otherwise(F.lit("response")),
            [
                ("WARC-Record-ID", mine),
                uri,
                digest,
                ("WARC-Profile", F.when(F.col("again"), F.lit(REVISIT_PROFILE))),
                ("WARC-Refers-To", F.when(F.col("again"), _urn("response", F.col("first.number").cast("string")))),
                http,
            ],
            F.concat(head, F.when(F.col("again"), F.lit("")).otherwise(F.col("body"))),
        ),
        _record(
            F.lit("metadata"),
            [("WARC-Record-ID", _urn("metadata", own)), to, uri, ("Content-Type", F.lit("application/warc-fields"))],
            F.concat(F.lit("page-id: "), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit("\r\n")),
        ),
    ]
    lines = told.select(F.concat_ws(END, *records).alias("value"))
    lines.write.option("maxRecordsPerFile", per_file).option("lineSep", END).option("compression", "gzip").text(path)


RECORD = (
    "record_id string, type string, concurrent_to array<string>, refers_to string, uri string, block_bytes long, "
    "payload_bytes long, payload_digest string, fields array<struct<name:string,value:string>>, payload binary"
)


def _fields(raw: bytes) -> list[tuple[str, str]]:
    """Named fields of a header block; a folded line belongs to the one before."""
    found: list[tuple[str, str]] = []
    for line in raw.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and found:
            found[-1] = (found[-1][0], f"{found[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            found.append((name.strip(), value.strip()))
    return found


def _unpacked(content: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """An archive's plain bytes bit by bit; of a gzip file with any number of members no more than a step is unpacked at once."""
    if content[:2] != b"\x1f\x8b":
        yield from (content[a : a + step] for a in range(0, len(content), step))
        return
    at = 0
    while at < len(content):
        member = zlib.decompressobj(wbits=31)
        while not member.eof:
            cut = content[at : at + step]
            if not cut and not member.unconsumed_tail:
                raise ValueError("the archive is cut off")
            at += len(cut)
            held = member.unconsumed_tail + cut
            while held and not member.eof:
                yield member.decompress(held, 4 * step)
                held = member.unconsumed_tail
        at -= len(member.unused_data)


class _Stream:
    """Bytes of an archive that are still to be read; what has been read is let go."""

    def __init__(self, content: bytes):
        self.parts, self.held, self.at, self.passed = _unpacked(content), bytearray(), 0, 0

    def _more(self) -> bool:
        part = next(self.parts, None)
        if part is None:
            return False
        if self.at:
            del self.held[: self.at]
            self.passed += self.at
            self.at = 0
        self.held += part
        return True

    def skip_breaks(self) -> bool:
        """Pass over line breaks between records; whether anything follows."""
        while True:
            while self.held[self.at : self.at + 2] == b"\r\n":
                self.at += 2
            if len(self.held) - self.at > 1:
                return True
            if not self._more():
                return len(self.held) > self.at

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to `mark`, which is passed over; None if it does not come."""
        begin = self.at
        while True:
            cut = self.held.find(mark, begin)
            if cut >= 0:
                found = bytes(self.held[self.at : cut])
                self.at = cut + len(mark)
                return found
            read = max(0, len(self.held) - self.at - len(mark) + 1)
            if not self._more():
                return None
            begin = self.at + read

    def take(self, size: int) -> bytes | None:
        while len(self.held) - self.at < size:
            if not self._more():
                return None
        found = bytes(self.held[self.at : self.at + size])
        self.at += size
        return found


def records_of(content: bytes) -> Iterator[dict]:
    """Records of one archive file, found by their lengths alone, so a payload may hold anything. One record is held at a time."""
    data = _Stream(content)
    while data.skip_breaks():
        begin = data.passed + data.at
        top = data.until(b"\r\n\r\n")
        if top is None or not top.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {begin}")
        head = _fields(top)
        named = {k.lower(): v for k, v in head}
        size = int(named["content-length"])
        block, kind = data.take(size), named.get("warc-type", "")
        if block is None:
            raise ValueError(f"the record at byte {begin} is cut off")
        fields, payload = [], block
        if "application/http" in named.get("content-type", ""):
            top, _, payload = block.partition(b"\r\n\r\n")
            fields = _fields(top)
        elif named.get("content-type") == "application/warc-fields":
            fields = _fields(block)
        full = {k.lower(): v for k, v in fields}.get("content-length", "")
        claimed = named.get("warc-payload-digest", "")
        revisit = kind == "revisit"
        yield {
            "record_id": named.get("warc-record-id"),
            "type": kind,
            "concurrent_to": [v for k, v in head if k.lower() == "warc-concurrent-to"],
            "refers_to": named.get("warc-refers-to"),
            "uri": named.get("warc-target-uri"),
            "block_bytes": size,
            "payload_bytes": int(full) if revisit and full.isdigit() else len(payload),
            "payload_digest": claimed.removeprefix("sha1:") if revisit else hashlib.sha1(payload).hexdigest(),
            "fields": [{"name": k, "value": v} for k, v in fields],
            "payload": payload,
        }


def _parse(with_payload: bool):
    kinds = [
        ("record_id", pa.string()),
        ("type", pa.string()),
        ("concurrent_to", pa.list_(pa.string())),
        ("refers_to", pa.string()),
        ("uri", pa.string()),
        ("block_bytes", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("fields", pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))),
        ("payload", pa.binary()),
    ]
    schema = pa.schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows, held = [], 0
                for record in records_of(batch.column("content")[i].as_py() or b""):
                    held += len(record["payload"]) + 500
                    rows.append(record if with_payload else {**record, "payload": None})
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records of all archives (plain or gzip) below `path`, one row each; without payloads if they are not wanted."""
    files = spark.read.schema("path string, modificationTime timestamp, length long, content binary").format("binaryFile").load(path)
    return files.select("content").mapInArrow(_parse(with_payload), RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per transaction: `capture_id`, `requests`, `response`, `metadata`, `n_requests`, `n_metadata`.

    A response or revisit stands under its own id, other records under the ids they are concurrent to; a metadata record that
    names a request goes where that request goes. `requests` and `metadata` are arrays of all their records by record id, without
    payloads; the bytes of a request stay in its record. `response` is null and the arrays are empty where a transaction has no
    such part. Records that repeat an id are all there, and of repeated responses the smallest.
    """
    main = records.where(F.col("type").isin("response", "revisit"))
    side = records.where(F.col("type").isin("request", "metadata")).select("*", F.explode_outer("concurrent_to").alias("to"))
    by_request = side.where("type = 'request' and to is not null").groupBy("record_id").agg(F.min("to").alias("via"))
    meta = side.where("type = 'metadata'").join(by_request.withColumnRenamed("record_id", "to"), "to", "left")
    keyed = (
        main.withColumn("key", F.col("record_id"))
        .drop("concurrent_to")
        .unionByName(side.where("type = 'request'").withColumn("key", F.coalesce("to", "record_id")).drop("concurrent_to", "to"))
        .unionByName(meta.withColumn("key", F.coalesce("via", "to", "record_id")).drop("concurrent_to", "to", "via"))
    )
    shown = ["record_id", "type", "refers_to", "uri", "block_bytes", "payload_bytes", "payload_digest", "fields"]
    answer = F.when(F.col("type").isin("response", "revisit"), F.struct(*shown, "payload"))
    sides = lambda kind: F.sort_array(F.collect_list(F.when(F.col("type") == kind, F.struct(*shown))))
    return keyed.groupBy(F.col("key").alias("capture_id")).agg(
        sides("request").alias("requests"),
        F.min(answer).alias("response"),
        sides("metadata").alias("metadata"),
        F.count_if(F.col("type") == "request").alias("n_requests"),
        F.count_if(F.col("type") == "metadata").alias("n_metadata"),
    )


def field(fields: Column, name: str) -> Column:
    """Value of the first of `fields` with this name."""
    return F.get(F.filter(fields, lambda x: F.lower(x["name"]) == name), F.lit(0))["value"]


def archive_round_trip(pages: DataFrame, with_payload: bool = False) -> DataFrame:
    """Write `pages` to fresh archives in the shared folder, read them back, and give the transactions with `page_id`."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    return assemble(read_records(spark, path, with_payload)).withColumn("page_id", field(F.get("metadata", F.lit(0))["fields"], "page-id").try_cast("long"))
