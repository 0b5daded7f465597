"""WARC archives: a writer with revisit records, and a splittable reader.

``write_warc`` writes a record per row, each as a gzip member of its own, in files
of bounded size under a shared folder.  Of rows with equal payloads the one with
the largest key is a ``response``, the others are ``revisit`` records that name
it and hold the HTTP headers only.  A group of more than a 1000th of all rows
meets its response by broadcast (there are fewer than 1000 such groups), the
others in a join.  A task that is run again writes new files; only the files in
the returned manifest count, which Spark commits as a table.

``read_index`` cuts the files into byte ranges, one row each.  A task looks for
gzip magic in its range, takes a place as a record only if its member decodes to a
WARC header, and owns the records that start inside the range, which it reads to
their end beyond it.  A member that lies inside another record (a stored archive
as payload) looks like a record to a range that starts in between; so records that
start before the end of an earlier one of their file are left out, and the rest
must cover the file without a gap, or the archive is damaged and an error tells
where.  Digest and size of a payload come from its decoded bytes, in pieces, and
are held against the headers.  ``payloads`` reads records at known places.

Defined cases: a null html is the empty payload; a null url has no target line;
control characters and blanks of urls are percent-encoded; null keys are the
smallest; of rows equal in key and payload one is the response, and the others
revisit it, so refers_to is their own key; an empty table writes no file; further
columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote
from uuid import uuid4

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from closeledger.llm.common import arrow_map, partitions, read_table, stored, stored_with
from closeledger.session import ensure_checkpoint_dir

#: Bytes after which a task starts a new file, and bytes of a reader's range.
FILE_BYTES, RANGE_BYTES = 256 << 20, 8 << 20
#: Payload bytes that a writing task has at least, unless there are fewer.
TASK_BYTES = 16 << 20
#: Bytes read from a file at once, bytes decoded at once, and bytes that a WARC or
#: HTTP header has at most.
READ_BYTES, FEED_BYTES, HEADER_BYTES = 1 << 20, 16 << 10, 1 << 20
#: Share of all rows from which a group of equal payloads is met by broadcast.
HOT = 1000

MAGIC = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
# Fixed values of the format.
VERSION = b"WARC/1."
RESPONSE, REVISIT, INFO = "response", "revisit", "warcinfo"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"

INDEX = (
    "path string, start long, stop long, record_type string, record_id string, url string, refers_id string, "
    "payload_bytes long, payload_digest string"
)


def file_of(uri: str) -> tuple[FileSystem, str]:
    """The file system and the path of a URI, as Spark or a user writes it."""
    uri = re.sub("^file:/(?!/)", "file:///", uri)
    return FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def digest_text(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(f"WARC/1.1\r\n{lines}\r\n".encode() + block + END) + packer.flush()


def record(kind: str, record_id: str, url: str | None, payload: bytes, refers_id: str | None, date: str) -> bytes:
    """One response or revisit record as a gzip member."""
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="".join(map(chr, range(0x21, 0x7F))))))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest_text(hashlib.sha1(payload).digest())}"))
    if kind == REVISIT:
        fields += [("WARC-Refers-To", f"<{refers_id}>"), ("WARC-Profile", PROFILE)]
    fields.append(("Content-Type", "application/http; msgtype=response"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _member(fields, http + (payload if kind == RESPONSE else b""))


def with_revisits(rows: DataFrame, total: int, least_bytes: int = 0) -> DataFrame:
    """``rows`` (row, key, size, digest, ...) with refers_id: the record that a
    row revisits, else null."""
    same = ["size", "digest"]
    slim = rows.select("row", "key", "record_id", *same).where(F.col("size") >= least_bytes)
    best = F.max(F.struct(F.col("key").isNotNull(), "key", "row", "record_id")).alias("best")
    groups = stored(slim.groupBy(*same).agg(F.count("*").alias("n"), best).where("n > 1"), "equal-payloads")
    groups = groups.select(*same, "n", F.col("best.row").alias("kept"), F.col("best.record_id").alias("refers_id"))
    hot, cold = groups.where(F.col("n") * HOT > total).drop("n"), groups.where(F.col("n") * HOT <= total).drop("n")
    meet = slim.join(F.broadcast(hot), same).unionByName(slim.join(F.broadcast(hot.select(*same)), same, "left_anti").join(cold, same))
    return rows.join(meet.where("row <> kept").select("row", "refers_id"), "row", "left")


def write_warc(pages: DataFrame, path: str, key: str, url: str, payload: str, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row under ``path``; the manifest (path, length,
    records) of the files."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload")
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), body, F.monotonically_increasing_id().alias("row"))
    name = F.concat(F.lit(URN), F.coalesce(F.concat(F.lit("k"), F.url_encode(F.col("key").cast("string"))), F.lit("")), F.lit(":"), F.col("row").cast("string"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("size"), F.sha1(F.col("payload").cast("binary")).alias("digest"), name.alias("record_id"))
    rows, totals = stored_with(rows, "pages", n=F.count("*"), bytes=F.sum("size"))
    rows = with_revisits(rows, totals["n"], least_bytes).select("record_id", "url", "payload", "refers_id")
    # small tables make few files; larger ones have a file per shuffle partition at least
    rows = rows.coalesce(max(1, min(partitions(pages.sparkSession), (totals["bytes"] or 0) // TASK_BYTES)))
    files, root = file_of(path)
    files.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = file_of(path)
        out, name, length, count = None, None, 0, 0

        def manifest() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([length]), pa.array([count])], names=["path", "length", "records"])

        for batch in batches:
            for record_id, url, text, refers_id in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if out is None:
                    name = f"{path.rstrip('/')}/{uuid4().hex}.warc.gz"
                    out, count = files.open_output_stream(f"{root.rstrip('/')}/{name.rsplit('/', 1)[1]}", compression=None), 1
                    info = [("WARC-Type", INFO), ("WARC-Record-ID", f"<urn:uuid:{uuid4()}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")]
                    head = _member(info, b"software: closeledger\r\nformat: WARC File Format 1.1\r\n")
                    out.write(head)
                    length = len(head)
                made = record(REVISIT if refers_id is not None else RESPONSE, record_id, url, text.encode(), refers_id, date)
                out.write(made)
                length, count = length + len(made), count + 1
                if length >= FILE_BYTES:
                    yield manifest()
                    out = None
        if out is not None:
            yield manifest()

    return stored(arrow_map(rows, write, "path string, length long, records long"), "manifest")


def archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the ``.warc.gz`` files under a folder."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", "true")
    return listed.load(path).select("path", "length")


class Archive:
    """One open archive file."""

    def __init__(self, path: str) -> None:
        files, place = file_of(path)
        self.path, self.file = path, files.open_input_file(place)
        self.length, self.held_at, self.held = self.file.size(), 0, b""

    def read(self, at: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``at`` on (none at the end only)."""
        inside = at - self.held_at
        if not 0 <= inside < len(self.held) and at < self.length:
            self.held_at, inside = at, 0
            self.held = self.file.read_at(min(READ_BYTES, self.length - at), at)
        return self.held[inside : inside + n] if at < self.length else b""

    def magic(self, at: int, stop: int) -> int | None:
        """First place of gzip magic from ``at`` on, before ``stop``."""
        tail = b""
        while at < stop + len(MAGIC) - 1:
            data = self.read(at, min(FEED_BYTES, stop + len(MAGIC) - 1 - at))
            if not data:
                return None
            data, at = tail + data, at + len(data)
            if (found := data.find(MAGIC)) >= 0:
                return at - len(data) + found
            tail = data[1 - len(MAGIC) :]
        return None

    def pieces(self, at: int) -> Iterator[tuple[bytes, int | None]]:
        """Decoded pieces of the member at ``at``; with the last, its end."""
        unpack = zlib.decompressobj(31)
        while not unpack.eof:
            data = self.read(at, FEED_BYTES)
            if not data:
                raise zlib.error("member ends early")
            at += len(data)
            more = True
            while more:
                piece = unpack.decompress(data, READ_BYTES)
                data = unpack.unconsumed_tail
                more = not unpack.eof and (data or len(piece) == READ_BYTES)
                yield piece, (at - len(unpack.unused_data) if unpack.eof else None)

    def record(self, at: int, take: Callable[[bytes], None] | None = None) -> tuple | None:
        """Index row of the record at ``at``; None where no whole record is.
        ``take`` gets the payload in pieces."""
        pieces = self.pieces(at)
        try:
            head, rest, stop = _header(pieces, b"", VERSION)
            fields = _fields(head)
            size = int(fields["content-length"])
            kind, record_id = fields["warc-type"], fields["warc-record-id"].strip("<>")
            http = kind in (RESPONSE, REVISIT) and fields.get("content-type", "").startswith("application/http")
            block = _Block(kind, size, http, take)
            block.add(rest)
            for piece, stop in pieces if stop is None else ():  # noqa: B007
                block.add(piece)
        except (zlib.error, KeyError, ValueError):
            return None
        if stop is None or block.left or block.tail != END:
            return None
        bytes_, digest = block.payload(fields)
        refers = fields.get("warc-refers-to")
        return self.path, at, stop, kind, record_id, fields.get("warc-target-uri"), refers and refers.strip("<>"), bytes_, digest


def _header(pieces: Iterator[tuple[bytes, int | None]], data: bytes, begins: bytes) -> tuple[bytes, bytes, int | None]:
    """Bytes up to the first empty line, those after it, and the member's end
    if it is known by then."""
    stop = None
    while (cut := data.find(END)) < 0:
        if not data.startswith(begins[: len(data)]) or len(data) > HEADER_BYTES or stop is not None:
            raise ValueError("no header")
        piece, stop = next(pieces, (b"", -1))
        data += piece
    if not data.startswith(begins):
        raise ValueError("no header")
    return data[:cut], data[cut + len(END) :], stop


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


class _Block:
    """The block of a record as its pieces come: HTTP header, then payload."""

    def __init__(self, kind: str, size: int, http: bool, take: Callable[[bytes], None] | None) -> None:
        self.http, self.left, self.tail, self.take = b"" if http else None, size, b"", take
        self.kind, self.sha1, self.bytes, self.fields = kind, hashlib.sha1(), 0, {}

    def add(self, piece: bytes) -> None:
        body, self.tail = piece[: self.left], self.tail + piece[self.left :]
        self.left -= len(body)
        if self.http is not None:
            self.http += body
            cut = self.http.find(END)
            if cut < 0:
                if len(self.http) > HEADER_BYTES:
                    raise ValueError("no HTTP header")
                return
            self.fields, body, self.http = _fields(self.http[:cut]), self.http[cut + len(END) :], None
        self.sha1.update(body)
        self.bytes += len(body)
        if self.take and body:
            self.take(body)

    def payload(self, fields: dict[str, str]) -> tuple[int | None, str | None]:
        told = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        if self.kind == REVISIT:
            return int(self.fields.get("content-length", "0")), told
        if self.kind != RESPONSE:
            return None, None
        digest = digest_text(self.sha1.digest())
        if told is not None and told != digest:
            raise OSError(f"payload digest of {fields['warc-record-id']} is {digest}, its header says {told}")
        return self.bytes, digest


def scan(path: str, start: int, stop: int) -> Iterator[tuple]:
    """Index rows of the records that start in a byte range of a file."""
    archive, at = Archive(path), start
    while (at := archive.magic(at, stop)) is not None:
        found = archive.record(at)
        if found is None:
            at += 1
        else:
            yield found
            at = found[2]
    archive.file.close()


def read_index(files: DataFrame, range_bytes: int | None = None) -> DataFrame:
    """One row per record of ``files`` (path, length), see ``INDEX``."""
    spark, step = files.sparkSession, range_bytes or RANGE_BYTES
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(step).cast("long")))
    ranges = files.where("length > 0").select("path", starts.alias("start"))
    n = files.agg(F.sum(F.ceil(F.col("length") / step)).alias("n")).first()["n"] or 1
    ranges = ranges.repartition(min(partitions(spark), int(n)))
    kinds = {"start": pa.int64(), "stop": pa.int64(), "payload_bytes": pa.int64()}
    names = [c.split()[0] for c in INDEX.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(found: list[tuple]) -> pa.RecordBatch:
            columns = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, columns, strict=True)], names=names)

        for batch in batches:
            for path, start in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                held = []
                for row in scan(path, start, start + step):
                    held.append(row)
                    if len(held) == 10_000:
                        yield rows(held)
                        held = []
                if held:
                    yield rows(held)

    found = stored(arrow_map(ranges, read, INDEX), "records")
    before = F.coalesce(F.max("stop").over(Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = found.withColumn("_cl_before", before).where("start >= _cl_before")
    found = stored(found, "index")
    seen = found.groupBy("path").agg(F.max("stop").alias("stop"), F.min(F.when(F.col("start") > F.col("_cl_before"), F.col("_cl_before"))).alias("gap"))
    end = F.coalesce("stop", F.lit(0))
    gaps = files.join(seen, "path", "left").where(F.col("gap").isNotNull() | (end < F.col("length")))
    bad = gaps.select("path", F.coalesce("gap", end).alias("at")).first()
    if bad is not None:
        raise OSError(f"{bad['path']}: no whole record at byte {bad['at']}")
    return found.drop("_cl_before")


def payloads(index: DataFrame) -> DataFrame:
    """``index`` with the payload bytes of each response record (else null),
    read at its place."""
    names = index.columns

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (path, start, kind) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("path", "start", "record_type")], strict=True)):
                body = bytearray()
                if kind == RESPONSE and Archive(path).record(start, body.extend) is None:
                    raise OSError(f"{path}: no whole record at byte {start}")
                one = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([*one.columns, pa.array([bytes(body) if kind == RESPONSE else None], pa.binary())], names=[*names, "payload"])

    return arrow_map(index, fetch, f"{INDEX}, payload binary")


def key_of(record_id: str) -> Column:
    """The key in a record id of the writer, as text (null for a null key)."""
    part = F.regexp_extract(record_id, f"^{URN}k([^:]*):", 1)
    return F.when(F.col(record_id).startswith(f"{URN}k"), F.url_decode(part))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as WARC records and read the archives back."""
    pages = read_table(spark, sf_dir, "pages")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/closeledger-llm/{uuid4().hex}/archives"
    index = read_index(write_warc(pages, path, "page_id", "url", "html"))
    kind = pages.schema["page_id"].dataType
    return index.where(F.col("record_type").isin(RESPONSE, REVISIT)).select(
        key_of("record_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        key_of("refers_id").cast(kind).alias("refers_to"),
    )


def oracle_sql() -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return f"""
WITH rows AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex,
         row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST) AS place,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS best
  FROM pages)
SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         substr('{letters}', 1 + ((('0x' || substr(hex, 1 + (i // 4) * 5, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN best END AS refers_to
FROM rows
"""
