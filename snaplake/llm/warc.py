"""WARC archives from a chunked record table.

A record is rows (record, chunk, last, data): no step holds a payload whole once
the table exists. The digest is carried from chunk to chunk, and the last chunk's
row has the full one. Equal payloads are told by digest and length on narrow
rows; chunks then meet their record's header by record, sorted, and are streamed
into gzip members. Reading streams the members back in chunks.

An archive counts only if the table of archives names it, which Spark commits
once per partition; what a lost or repeated attempt leaves is never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import open_shared, settle
from snaplake.session import work_dir

CHUNK = 64 << 10
LEVEL = 3
NAMESPACE = uuid.UUID("5a7d9b52-6a3f-4f0e-9f43-2b8d1c0c7e11")
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
TABLE = "record long, page_id long, url string, chunk long, last boolean, data binary, bytes long, digest binary"


def chunked(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            chunk: int = CHUNK) -> DataFrame:
    """The record table (``TABLE``): chunks of the UTF-8 payload in order, with the
    bytes and the SHA-1 up to and including each. A null or empty payload is
    one empty chunk. Every row of ``pages`` is a record of its own."""
    data = F.coalesce(F.col(payload_col).cast("string").cast("binary"), F.lit(b"").cast("binary"))
    cuts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.octet_length("data") / chunk) - 1).cast("int"))
    rows = (pages.select(F.monotonically_increasing_id().alias("record"), F.col(id_col).cast("long").alias("page_id"),
                         F.col(url_col).cast("string").alias("url"), data.alias("data"))
            .select("record", "page_id", "url", F.posexplode(F.transform(cuts, lambda i: F.substr("data", i * chunk + 1, F.lit(chunk))))
                    .alias("chunk", "data"), (F.size(cuts) - 1).alias("most")))

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha, size = hashlib.sha1(), 0
        for batch in batches:
            digests, sizes = [], []
            for no, data in zip(batch.column("chunk").to_pylist(), batch.column("data")):
                if no == 0:
                    sha, size = hashlib.sha1(), 0
                view = data.as_buffer()
                sha.update(view)
                size += len(view)
                digests.append(sha.copy().digest())
                sizes.append(size)
            yield pa.record_batch({
                "record": batch.column("record"), "page_id": batch.column("page_id"), "url": batch.column("url"),
                "chunk": batch.column("chunk").cast(pa.int64()),
                "last": pa.compute.equal(batch.column("chunk"), batch.column("most")), "data": batch.column("data"),
                "bytes": pa.array(sizes, pa.int64()), "digest": pa.array(digests, pa.binary())})

    return settle(rows.mapInArrow(carry, TABLE), "warc-chunks")


def headers(chunks: DataFrame, least: int = 0) -> DataFrame:
    """One row per record: its size and digest, and for all but one of the records
    with the same payload of at least ``least`` bytes, the one it refers to
    (``to_record``, ``to_page``): that with the largest page id, of repeated ids
    the last record. A digest that many records share is combined before the
    shuffle, and adaptive execution splits its rows in the join."""
    ends = chunks.where("last").select("record", "page_id", "url", "bytes", "digest")
    first = (ends.where(F.col("bytes") >= least).groupBy("digest", "bytes")
             .agg(F.max(F.struct("page_id", "record")).alias("to"), F.count("*").alias("n")).where("n > 1").drop("n"))
    to = F.when(F.col("to.record") != F.col("record"), F.col("to"))
    return (ends.join(first, ["digest", "bytes"], "left").withColumn("to", to)
            .select("record", "page_id", "url", "bytes", "digest", F.col("to.record").alias("to_record"),
                    F.col("to.page_id").alias("to_page")))


def _record_id(record: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, str(record))}>"


def _head(row: dict, date: str) -> bytes:
    revisit = row["to_record"] is not None
    http = HTTP % row["bytes"]
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(row['record'])}",
             f"WARC-Date: {date}"]
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"]))
    lines += [f"WARC-Payload-Digest: sha1:{base64.b32encode(row['digest']).decode()}",
              f"X-Payload-Length: {row['bytes']}", "Content-Type: application/http; msgtype=response"]
    if row["page_id"] is not None:
        lines.append(f"X-Page-Id: {row['page_id']}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(row['to_record'])}"]
        if row["to_page"] is not None:
            lines.append(f"X-Refers-To-Page: {row['to_page']}")
    lines.append(f"Content-Length: {len(http) + (0 if revisit else row['bytes'])}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def write_warc(chunks: DataFrame, heads: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write the records, each a gzip member, and return the table of archives
    (path, records). Revisits carry no payload."""
    folder = work_dir(chunks.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, path, member, skip, records = None, None, None, False, 0
        for batch in batches:
            for i in range(batch.num_rows):
                no = batch.column("chunk")[i].as_py()
                if no < 0:
                    row = {n: batch.column(n)[i].as_py() for n in ("record", "page_id", "url", "bytes", "digest", "to_record", "to_page")}
                    if sink is None:
                        path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                        fs, inner = open_shared(folder)
                        fs.create_dir(inner, recursive=True)
                        fs, inner = open_shared(path)
                        sink = fs.open_output_stream(inner, compression=None)
                    member, skip = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), row["to_record"] is not None
                    records += 1
                    sink.write(member.compress(_head(row, date)))
                    end = skip
                else:
                    if skip:
                        continue
                    sink.write(member.compress(batch.column("data")[i].as_buffer()))
                    end = batch.column("last")[i].as_py()
                if end:
                    sink.write(member.compress(b"\r\n\r\n") + member.flush())
        if sink is not None:
            sink.close()
            yield pa.record_batch({"path": [path], "records": pa.array([records], pa.int64())})

    rows = heads.withColumn("chunk", F.lit(-1).cast("long")).unionByName(
        chunks.select("record", "chunk", "last", "data"), allowMissingColumns=True)
    rows = rows.repartition("record").sortWithinPartitions("record", "chunk")
    return settle(rows.mapInArrow(write, "path string, records long"), "warc-files")


class _Members:
    """The records of one archive, as a stream of decompressed bytes each."""

    def __init__(self, source):
        self.source, self.raw, self.out, self.box = source, b"", b"", None

    def more(self) -> bool:
        """Decompress a further piece of the current member."""
        if self.box is None or self.box.eof:
            return False
        if not self.raw:
            self.raw = self.source.read(CHUNK)
            if not self.raw:
                raise EOFError("an archive ends inside a record")
        self.out += self.box.decompress(self.raw, CHUNK)
        self.raw = self.box.unconsumed_tail or self.box.unused_data
        return True

    def next(self) -> bool:
        while self.more():
            self.out = b""
        self.raw = self.raw or self.source.read(CHUNK)
        self.box, self.out = zlib.decompressobj(31), b""
        return bool(self.raw)

    def until(self, mark: bytes) -> bytes:
        while mark not in self.out:
            if not self.more():
                raise ValueError("a record lacks its header's end")
        head, _, self.out = self.out.partition(mark)
        return head

    def take(self, count: int) -> Iterator[bytes]:
        while count:
            if not self.out and not self.more():
                raise EOFError("a record is shorter than its length")
            part, self.out = self.out[:count], self.out[count:]
            count -= len(part)
            yield part


def read_records(source) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
    """(WARC header, payload chunks) of every record in an open archive; revisits
    have no payload. The chunks must be used before the next record."""
    members = _Members(source)
    while members.next():
        lines = members.until(b"\r\n\r\n").decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        head = dict(x.split(": ", 1) for x in lines[1:])
        http = members.until(b"\r\n\r\n")
        yield head, members.take(int(head["Content-Length"]) - len(http) - 4)


def read_warc(files: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per record,
    read from the archives. A response whose payload has not the digest or
    length in its header raises an error."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, inner = open_shared(path)
                out = []
                with fs.open_input_stream(inner, compression=None) as source:
                    for head, payload in read_records(source):
                        digest, size = head["WARC-Payload-Digest"].removeprefix("sha1:"), int(head["X-Payload-Length"])
                        if head["WARC-Type"] == "response":
                            sha, got = hashlib.sha1(), 0
                            for part in payload:
                                sha.update(part)
                                got += len(part)
                            if (base64.b32encode(sha.digest()).decode(), got) != (digest, size):
                                raise ValueError(f"{head['WARC-Record-ID']}: payload differs from its digest")
                        page, to = head.get("X-Page-Id"), head.get("X-Refers-To-Page")
                        out.append((None if page is None else int(page), size, digest, head["WARC-Type"], None if to is None else int(to)))
                        if len(out) == 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                            out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    spread = files.repartition(max(1, files.count()))
    return spread.mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0,
            chunk: int = CHUNK) -> DataFrame:
    """Write a record per row of ``pages`` and return the table of archives. Null
    urls and ids are left out of the header; other columns are not read."""
    chunks = chunked(pages, id_col, url_col, payload_col, chunk)
    return write_warc(chunks, headers(chunks, least))
