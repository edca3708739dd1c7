"""Web archives: one gzip member per record, written by tasks and read in sequence.

Writing. A task streams its pages into archive files of bounded size; a file gets a name of its own, so that a second attempt of a
task never writes into the first one's, and what counts is the manifest that Spark keeps of the tasks that ended. Pages
with equal payloads are found by length and SHA-256 before; all but one are stored as revisits, without payload.

Reading. A task opens a file of the manifest as a stream and inflates member by member, some hundred kilobytes at a time. The record's head is
framed by its blank line, the block by Content-Length; block and payload run through SHA-1 as they come, and are compared
with what the record declares. A damaged member becomes a row with its fault, and reading goes on at the next member that begins a record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint_folder, checkpointed, numbered, ranked_id, text_blocks, text_bytes

#: Compressed bytes after which a task begins another file.
FILE_BYTES = 256 << 20
#: Compressed bytes read at once, and bytes inflated at once.
PIECE, INFLATED = 1 << 18, 1 << 20
#: Most bytes of a record's head, and of the HTTP head in its block.
HEAD_BYTES = 1 << 20
#: Groups of equal payloads (about 100 bytes each) that are broadcast at most.
FEW_GROUPS = 200_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"
MAGIC = b"\x1f\x8b\x08"


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), path) if "://" not in path else fs.FileSystem.from_uri(path)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key: object, row: int) -> str:
    """A URN of the page's id and row; a null id has no second part."""
    return f"urn:page:{row}" + ("" if key is None else f":{quote(str(key), safe='')}")


def page_in(urn: str) -> Column:
    """The page's id, as text, in a column of URNs of ``record_id``."""
    head = r"^urn:page:[0-9]+:"
    return F.when(F.col(urn).rlike(head), F.url_decode(F.regexp_replace(urn, head, "")))


def record(kind: str, urn: str, refers_to: str | None, url: str | None, payload: bytes, date: str = DATE) -> bytes:
    """A gzip member of one record: response with its payload, or revisit with the HTTP head alone."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = payload if kind == "response" else b""
    block = hashlib.sha1(head)
    block.update(body)
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{urn}>"), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="".join(map(chr, range(33, 127))))))
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    fields += [
        ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
        ("WARC-Block-Digest", f"sha1:{base64.b32encode(block.digest()).decode()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(head) + len(body))),
    ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    return b"".join([gz.compress(b"WARC/1.1\r\n" + lines + b"\r\n" + head), gz.compress(body), gz.compress(b"\r\n\r\n"), gz.flush()])


def revisits(rows: DataFrame, id_col: str, payload_col: str, row: str, least: int) -> DataFrame:
    """``rows`` with refers_id and refers_row: of the first page with an equal payload of ``least`` bytes or more, null for
    that page itself and for pages whose payload no other has. Few groups, which are counted first, are sent to the rows; more of them meet the rows in a shuffle."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    key = F.unhex(F.sha2(payload.cast("binary"), 256))
    keyed = rows.withColumns({"_sha": key, "_size": F.octet_length(payload)})
    groups = keyed.where(F.col("_size") >= least).groupBy(F.col("_sha").alias("_s"), F.col("_size").alias("_z")).agg(F.min(ranked_id(id_col, row)).alias("_first"), F.count(F.lit(1)).alias("_n"))
    groups = checkpointed(groups.where("_n > 1").drop("_n"))
    few = groups.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS
    met = keyed.join(F.broadcast(groups) if few else groups, (F.col("_sha") == F.col("_s")) & (F.col("_size") == F.col("_z")), "left")
    other = F.col("_first.row") != F.col(row)
    return met.select(*rows.columns, F.when(other, F.col("_first.id")).alias("refers_id"), F.when(other, F.col("_first.row")).alias("refers_row"))


def write_archives(
    pages: DataFrame, folder: str | None = None, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0, date: str = DATE, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Write a record for each row of ``pages`` below ``folder`` and return the manifest: path, records and bytes of each file.

    ``folder`` (a path or URI that tasks can open by pyarrow: a shared mount, an object store, hdfs) is one in the shared checkpoint folder if
    left out. Of rows with equal payloads of ``least`` bytes or more, that with the smallest id (of repeated ids one, null ids last)
    becomes a response and the others revisits. A null payload is an empty one, a null url has no target field, and control characters, spaces and
    other than ASCII in a url are percent-encoded. Files that the manifest doesn't list are of attempts that failed. No rows, no files; other
    columns are not stored.
    """
    spark = pages.sparkSession
    folder = folder or f"{checkpoint_folder(spark)}/warc-{uuid.uuid4().hex}"
    named = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(payload_col).cast("string").alias("payload"))
    rows, row = numbered(named)
    marked = revisits(rows, "id", "payload", row, least)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(folder)
        store.create_dir(root, recursive=True)
        out, name, records, size = None, "", 0, 0

        def entry() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records], pa.int64()), pa.array([size], pa.int64())], ["path", "records", "bytes"])

        for block in text_blocks(batches, "payload"):
            columns = [block.column(c).to_pylist() for c in ("id", row, "url", "refers_id", "refers_row")]
            for key, number, url, to, to_row, payload in zip(*columns, text_bytes(block.column("payload")), strict=True):
                if out is None:
                    name, records, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(store_of(name)[1], compression=None)
                kind = "response" if to_row is None else "revisit"
                member = record(kind, record_id(key, number), None if to_row is None else record_id(to, to_row), url, payload, date)
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield entry()
        if out is not None:
            out.close()
            yield entry()

    return checkpointed(marked.mapInArrow(write, "path string, records long, bytes long"))


class Record:
    """A record that comes in pieces; ``add`` takes them, ``done`` tells what was found."""

    def __init__(self, keep: bool) -> None:
        self.head, self.fields, self.keep = bytearray(), None, keep
        self.length = self.seen = self.payload_seen = 0
        self.block, self.payload = hashlib.sha1(), hashlib.sha1()
        self.http: bytearray | None = bytearray()
        self.parts: list[bytes] = []
        self.tail = b""

    def add(self, data: bytes) -> None:
        if self.fields is None:
            self.head += data
            end = self.head.find(b"\r\n\r\n")
            if not b"WARC/1."[: len(self.head)] == bytes(self.head[:7]):
                raise ValueError("no record begins here")
            if end < 0:
                if len(self.head) > HEAD_BYTES:
                    raise ValueError("the head has no end")
                return
            lines = bytes(self.head[:end]).decode("utf-8", "replace").split("\r\n")[1:]
            self.fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
            if not self.fields.get("content-length", "").isdigit():
                raise ValueError("no content length")
            self.length = int(self.fields["content-length"])
            if "application/http" not in self.fields.get("content-type", ""):
                self.http = None
            data, self.head = bytes(self.head[end + 4 :]), bytearray()
        body, rest = data[: self.length - self.seen], data[self.length - self.seen :]
        self.tail += rest
        if len(self.tail) > 4:
            raise ValueError("more than the content length")
        self.seen += len(body)
        self.block.update(body)
        if self.http is not None and b"\r\n\r\n" not in self.http:
            self.http += body
            end = self.http.find(b"\r\n\r\n")
            if end < 0:
                if len(self.http) > HEAD_BYTES:
                    raise ValueError("the HTTP head has no end")
                return
            body = bytes(self.http[end + 4 :])
            del self.http[end + 4 :]
        self.payload.update(body)
        self.payload_seen += len(body)
        if self.keep:
            self.parts.append(body)

    def declared(self, field: str) -> str | None:
        value = (self.fields or {}).get(field)
        return value.partition(":")[2].upper() if value and value.lower().startswith("sha1:") else None

    def done(self) -> dict[str, object]:
        if self.fields is None:
            raise ValueError("the head has no end")
        if self.seen < self.length or self.tail != b"\r\n\r\n":
            raise ValueError("less than the content length")
        if (want := self.declared("warc-block-digest")) and want != base64.b32encode(self.block.digest()).decode():
            raise ValueError("the block's digest differs")
        kind, digest = self.fields.get("warc-type"), self.declared("warc-payload-digest")
        size = self.payload_seen
        if kind == "revisit":  # its payload is elsewhere
            told = [x.partition(b":")[2].strip() for x in bytes(self.http or b"").split(b"\r\n") if x.lower().startswith(b"content-length:")]
            size = int(told[0]) if told and told[0].isdigit() else None
        elif digest and digest != base64.b32encode(self.payload.digest()).decode():
            raise ValueError("the payload's digest differs")
        bare = {k: (self.fields.get(k) or "").strip("<>") or None for k in ("warc-record-id", "warc-refers-to")}
        return {
            "record_id": bare["warc-record-id"],
            "record_type": kind,
            "target_uri": self.fields.get("warc-target-uri"),
            "refers_to": bare["warc-refers-to"],
            "payload_digest": digest or base64.b32encode(self.payload.digest()).decode(),
            "payload_bytes": size,
            "payload": b"".join(self.parts) if self.keep and kind != "revisit" else None,
        }


def records_of(stream, keep: bool) -> Iterator[dict[str, object]]:
    """A dict for each member of a stream that can seek: what ``Record.done`` has, offset, and fault (null if all is right).
    Members that can't be read are one row up to the next member that begins a record."""
    start, damaged, at, data = 0, False, 0, b""

    def more() -> bytes:
        return stream.read(PIECE)

    while True:
        data = data or more()
        if not data:
            return
        inflate, made, fault = zlib.decompressobj(31), Record(keep), None
        try:
            while not inflate.eof:
                if not data and not (data := more()):
                    raise ValueError("the archive ends inside a member")
                at += len(data)
                piece = inflate.decompress(data, INFLATED)
                while True:
                    made.add(piece)
                    if inflate.eof or not inflate.unconsumed_tail:
                        break
                    piece = inflate.decompress(inflate.unconsumed_tail, INFLATED)
                data = inflate.unused_data
                at -= len(data)
            found = made.done()
        except (zlib.error, ValueError) as problem:
            fault = str(problem)
        if fault is None:
            yield found | {"offset": start, "fault": None}
            start, damaged = at, False
            continue
        if not damaged:
            yield {"offset": start, "fault": fault}
        # On to the next place where a member may begin.
        damaged, at = True, start + 1
        stream.seek(at)
        data = b""
        while True:
            piece = more()
            if not piece:
                return
            data += piece
            place = data.find(MAGIC)
            if place >= 0:
                start = at = at + place
                data = data[place:]
                break
            at, data = at + len(data) - len(data[-2:]), data[-2:]


READ = "path string, offset long, record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary, fault string"


def read_archives(archives: DataFrame, *, payloads: bool = True, tasks: int | None = None) -> DataFrame:
    """A row for each record of the files in the column path: path, offset (of its member), record_id, record_type, target_uri, refers_to (a
    record id), payload_digest (bare base32 SHA-1), payload_bytes, payload (null in revisits, or where ``payloads`` is false: then
    a task holds no payload) and fault.

    Lengths and digests are those of the full payload in revisits too, as declared there. A record whose member, length or digests are wrong has a row with
    path, offset and fault alone, and so has a file that can't be opened. A path that repeats is read again; a null one
    gives no rows. ``tasks``: partitions, over which the files are dealt.
    """
    names = [x.split()[0] for x in READ.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split()[1]]) for n, x in zip(names, READ.split(", "), strict=True)])

        def found(path: str) -> Iterator[dict[str, object]]:
            store, place = store_of(path)
            try:
                stream = store.open_input_file(place)
            except OSError as problem:
                yield {"path": path, "fault": f"can't be opened: {problem}"}
                return
            with stream:
                for r in records_of(stream, payloads):
                    yield r | {"path": path}

        for batch in batches:
            for path in batch.column("path").drop_null().to_pylist():
                held, size = [], 0
                for r in found(path):
                    held.append(r)
                    size += len(r.get("payload") or b"") + 500
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema)

    files = archives.select(F.col("path").cast("string").alias("path"))
    # Dealt anew: else the few short rows of a manifest end up in one task.
    return files.repartition(tasks or max(4 * archives.sparkSession.sparkContext.defaultParallelism, 64), "path").mapInArrow(read, READ)
