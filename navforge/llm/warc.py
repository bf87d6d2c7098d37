"""WARC archives and the chunked record table (operator 1).

Writing: records of a table go to gzip files of one WARC stream each.  Payloads
are compared by SHA-1 and length; of equal payloads of at least
``revisit_bytes`` bytes the record with the largest id is a response and the
others are revisits without payload.  Payloads are shuffled only by (digest,
id), which is as good as unique, so a payload that a third of all records share
does not meet in one task; revisits travel as narrow rows.

Reading: a gzip file is one task's stream of lines.  The reader follows
Content-Length and turns every record into rows (record identifier, chunk
number, data), each with the payload's length and digest up to there, so it
holds one chunk and one line of a record at a time.  Payloads over a chunk are
written in HTTP's chunked transfer coding, whose chunks end with a line feed, so
that no payload of these archives is one long line; the reader decodes it.  Lines
of other archives that are longer are held whole, by Spark's reader and the worker.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from navforge.llm.common import Scratch, ship

#: Payload bytes of a chunk row, and of a chunk of the transfer coding.
CHUNK_BYTES = 1 << 18
#: Lines that a Python worker takes from an Arrow batch at a time.
LINES = 64
#: Base32 alphabet (fixed value).
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: The date all records carry; archives of one table are then equal byte for byte.
WARC_DATE = "2024-01-01T00:00:00Z"
_ID = "urn:page:"

CHUNK_SCHEMA = ("record_id string, record_type string, target_uri string, refers_to string, "
                "declared_digest string, chunk_no long, chunk binary, payload_bytes long, "
                "payload_digest string, is_last boolean")
_CHUNK = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
    ("refers_to", pa.string()), ("declared_digest", pa.string()), ("chunk_no", pa.int64()),
    ("chunk", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("is_last", pa.bool_())])


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: 160 bits as 8 groups of 20 bits, 4 digits each."""
    hexed = F.sha1(payload)
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    groups = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), digits, BASE32)


def plan_records(pages: DataFrame, id_col: str, payload_col: str, uri_col: str | None,
                 revisit_bytes: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(responses with payload, revisits without) of all rows.

    The response of a group is its largest id (rows that share that id are all
    responses).  Null ids are smallest; a group of null ids only has responses.
    """
    uri = F.col(uri_col).cast("string") if uri_col else F.lit(None).cast("string")
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    records = pages.select(F.col(id_col).cast("long").alias("id"), uri.alias("uri"),
                           payload.alias("payload"))
    records = records.withColumns({"digest": sha1_base32(F.col("payload")),
                                   "size": F.octet_length("payload").cast("long")})
    winners = scratch.write(
        records.filter(F.col("size") >= revisit_bytes).groupBy("digest", "size")
        .agg(F.max("id").alias("winner")), "winners")
    narrow = (records.select("id", "uri", "digest", "size").join(winners, ["digest", "size"])
              .filter("winner is not null and (id is null or id < winner)"))
    revisits = narrow.select("id", "uri", "digest", "size", F.col("winner").alias("refers_to"))
    small = records.filter(F.col("size") < revisit_bytes)
    keyed = winners.select("digest", "size", F.col("winner").alias("id"))
    large = (records.filter(F.col("size") >= revisit_bytes)
             .join(keyed, (records["digest"] == keyed["digest"])
                   & (records["size"] == keyed["size"])
                   & records["id"].eqNullSafe(keyed["id"]), "left_semi"))
    return (small.unionByName(large) if revisit_bytes > 0 else large), revisits


def _head(kind: str, extra: list[Column], block: Column) -> Column:
    uri = F.regexp_replace(F.coalesce("uri", F.lit("")), "[\\r\\n]", "%0A")
    end = F.lit("\r\n")
    return F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{_ID}"),
        F.coalesce(F.col("id").cast("string"), F.lit("null")),
        F.lit(f">\r\nWARC-Date: {WARC_DATE}\r\nWARC-Target-URI: "), uri,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"), end, *extra,
        F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block)


def transfer_chunks(payload: Column) -> Column:
    """The payload in chunked transfer coding, as text.

    The payload is the variable of an outer lambda: each chunk then cuts its bytes out
    of one value instead of deriving the whole payload again.
    """
    def coded(whole: Column) -> Column:
        def chunk(i: Column) -> Column:
            data = F.substring(whole, i * CHUNK_BYTES + 1, F.lit(CHUNK_BYTES))
            return F.concat(F.hex(F.octet_length(data).cast("long")), F.lit("\r\n"),
                            data.cast("string"), F.lit("\r\n"))

        last = F.floor((F.octet_length(whole) - 1) / F.lit(CHUNK_BYTES)).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), last), chunk), "")

    return F.concat(F.transform(F.array(payload), coded)[0], F.lit("0\r\n\r\n"))


def write_warc(pages: DataFrame, path: str, scratch: Scratch, *, id_col: str = "page_id",
               payload_col: str = "html", uri_col: str | None = "url",
               revisit_bytes: int = 0) -> None:
    """Write one record per row under ``path`` (gzip, any file system of Spark).

    The payload is bytes or text in UTF-8, null as empty; line ends in a URI are
    escaped.  Payloads over CHUNK_BYTES are in chunked transfer coding; digests are
    those of the payload itself.  Further columns are not archived.
    """
    responses, revisits = plan_records(pages, id_col, payload_col, uri_col, revisit_bytes, scratch)
    kind = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n")
    http = F.concat(kind, F.lit("Content-Length: "), F.col("size").cast("string"),
                    F.lit("\r\n\r\n"))
    coded = F.concat(kind, F.lit("Transfer-Encoding: chunked\r\n\r\n"),
                     transfer_chunks(F.col("payload")))
    message = F.when(F.col("size") > CHUNK_BYTES, coded).otherwise(
        F.concat(http, F.col("payload").cast("string")))
    full = _head("response", [], message)
    bare = _head("revisit", [
        F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
              f"\r\nWARC-Refers-To: <{_ID}"), F.col("refers_to").cast("string"),
        F.lit(">\r\n")], http)
    lines = responses.select(full.alias("value")).unionByName(revisits.select(bare.alias("value")))
    # A record ends with two line ends, which the text writer puts after each row.
    (lines.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path))


class _Record:
    """One record as it streams by: headers, then payload pieces."""

    def __init__(self):
        self.headers: dict[str, str] = {}
        self.left = 0          # bytes of the block to come
        self.in_http = False   # before the payload of an HTTP message
        self.sha = hashlib.sha1()
        self.size = 0
        self.no = 0
        self.held: list[bytes] = []
        self.held_size = 0
        self.coded = False     # the payload is in chunked transfer coding
        self.todo = 0          # bytes to come of a chunk of that coding
        self.line = b""        # a line of that coding, as far as it is read
        self.expect = "first"  # first or further size line, end of a chunk, trailer

    def decoded(self, data: bytes) -> Iterator[bytes]:
        """The payload in ``data``.  Where the first line is no chunk size, the archive
        holds the payload as it is (some writers decode and keep the header)."""
        at = 0
        while at < len(data):
            if not self.coded:
                yield data[at:]
                return
            if self.todo:
                piece = data[at:at + self.todo]
                at += len(piece)
                self.todo -= len(piece)
                self.expect = "end" if not self.todo else "data"
                yield piece
                continue
            if self.expect == "trailer":
                return
            end = data.find(b"\n", at)
            stop = len(data) if end < 0 else end + 1
            self.line += data[at:stop]
            at = stop
            digits = self.line.partition(b";")[0].strip()
            if end < 0 and (self.expect != "first" or len(self.line) <= 32):
                continue
            line, self.line = self.line, b""
            if self.expect == "end":
                if digits:
                    raise ValueError(f"a chunk is longer than its size: {line[:40]!r}")
                self.expect = "size"
            elif end >= 0 and 0 < len(digits) <= 16 and not digits.strip(
                    b"0123456789abcdefABCDEF"):
                self.todo = int(digits, 16)
                self.expect = "data" if self.todo else "trailer"
            elif self.expect == "first":
                self.coded = False
                yield line
            else:
                raise ValueError(f"no size of a chunk: {line[:40]!r}")

    def rest(self) -> bytes:
        """What was read of a first line that the record's end cut off."""
        line = self.line if self.coded and self.expect == "first" else b""
        self.line = b""
        return line

    def add(self, data: bytes, limit: int) -> Iterator[tuple]:
        at = 0
        while at < len(data):
            take = data[at:at + limit - self.held_size]
            at += len(take)
            self.held.append(take)
            self.held_size += len(take)
            if self.held_size == limit and at < len(data):
                yield self.row(False)

    def row(self, last: bool) -> tuple:
        chunk = b"".join(self.held)
        self.held, self.held_size = [], 0
        self.sha.update(chunk)
        self.size += len(chunk)
        self.no += 1
        h = self.headers
        strip = lambda k: h[k].strip("<>") if k in h else None
        return (strip("warc-record-id"), h.get("warc-type"), h.get("warc-target-uri"),
                strip("warc-refers-to"), h.get("warc-payload-digest", "").removeprefix("sha1:"),
                self.no - 1, chunk, self.size,
                base64.b32encode(self.sha.copy().digest()).decode(), last)


def _chunks(limit: int, http_types: tuple[str, ...] = ("response", "revisit", "request")):
    def records(lines: Iterator[tuple[str, bytes]]) -> Iterator[tuple]:
        """State: between records (None), in headers (left < 0), or in a block."""
        rec, here, open_headers = None, None, False
        for file, line in lines:
            if file != here:
                if rec is not None:
                    raise ValueError(f"{here} ends within a record")
                here = file
            line += b"\n"
            if rec is None:
                if line in (b"\r\n", b"\n"):
                    continue
                if not line.startswith(b"WARC/"):
                    raise ValueError(f"{here}: no record starts at {line[:40]!r}")
                rec, open_headers = _Record(), True
                continue
            if open_headers:
                if line in (b"\r\n", b"\n"):
                    open_headers = False
                    rec.left = int(rec.headers.get("content-length", 0))
                    rec.in_http = rec.headers.get("content-type", "").startswith(
                        "application/http") and rec.headers.get("warc-type") in http_types
                    if not rec.left:
                        yield rec.row(True)
                        rec = None
                else:
                    name, _, value = line.decode("utf-8", "replace").partition(":")
                    rec.headers[name.strip().lower()] = value.strip()
                continue
            data = line[:rec.left]
            rec.left -= len(data)
            if rec.in_http:
                rec.in_http = data not in (b"\r\n", b"\n")
                name, _, value = data.partition(b":")
                if name.strip().lower() == b"transfer-encoding":
                    rec.coded = value.strip().lower() == b"chunked"
            elif rec.coded:
                for piece in rec.decoded(data):
                    yield from rec.add(piece, limit)
            else:
                yield from rec.add(data, limit)
            if not rec.left:
                yield from rec.add(rec.rest(), limit)
                yield rec.row(True)
                rec = None
        if rec is not None:
            raise ValueError(f"{here} ends within a record")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lines():
            for batch in batches:
                for i in range(0, batch.num_rows, LINES):
                    part = batch.slice(i, LINES)
                    yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist())

        held, size = [], 0
        for row in records(lines()):
            held.append(row)
            size += len(row[6]) + 200
            if size >= 4 * CHUNK_BYTES:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*held), _CHUNK)], schema=_CHUNK)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*held), _CHUNK)], schema=_CHUNK)

    return run


def read_warc(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunked record table of gzip WARC files (one member or one per record).

    Every record has at least one row; ``is_last`` marks its last, whose
    payload_bytes and payload_digest are those of the full payload, without a chunked
    transfer coding.  A record that the file's end cuts off raises an error, so does a
    coding that contradicts itself; one that its record cuts off ends the payload there.
    """
    ship(spark)
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select(F.col("_metadata.file_path").alias("file"),
                     F.col("value").cast("binary").alias("line")))
    return lines.mapInArrow(_chunks(chunk_bytes), CHUNK_SCHEMA)


def archive_round_trip(pages: DataFrame, *, id_col: str = "page_id", payload_col: str = "html",
                       uri_col: str | None = "url", revisit_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives, read them back, and describe every record.

    A revisit takes length and digest from the response that it refers to, as
    read; a digest that differs from the one its header declares is an error.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    path = scratch.path("archive")
    write_warc(pages, path, scratch, id_col=id_col, payload_col=payload_col, uri_col=uri_col,
               revisit_bytes=revisit_bytes)
    page = lambda c: F.regexp_extract(c, f"^{_ID}(-?[0-9]+)$", 1)
    number = lambda c: F.expr(f"try_cast(nullif({c}, '') as bigint)")
    last = (read_warc(spark, path).filter("is_last").withColumns(
        {"own": page("record_id"), "other": page("refers_to")})
        .select(number("own").alias(id_col), "record_type", number("other").alias("refers_to"),
                "declared_digest", "payload_bytes", "payload_digest"))
    last = scratch.write(last, "records")
    scratch.drop("winners", "archive")
    checked = F.when(F.col("payload_digest") == F.col("declared_digest"), F.col("payload_digest")) \
        .otherwise(F.raise_error(F.concat(F.lit("digest of a record differs: "),
                                          F.col("declared_digest"))))
    responses = last.filter("record_type = 'response'").withColumn("payload_digest", checked)
    target = responses.select(F.col(id_col).alias("refers_to"), "payload_bytes",
                              F.col("payload_digest").alias("found"),
                              ).withColumn("declared_digest", F.col("found")).distinct()
    revisits = (last.filter("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
                .join(target, ["refers_to", "declared_digest"], "left")
                .withColumn("payload_digest", F.coalesce(
                    "found", F.raise_error(F.lit("a revisit refers to no response")).cast("string"))))
    cols = [id_col, "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(cols).unionByName(revisits.select(cols))
