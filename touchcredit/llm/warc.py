"""WARC archives: monolithic gzip normalised to one member per record, with a sidecar offset index.

Each partition first writes its records as one gzip stream, the form crawlers
often deliver. The normaliser inflates that stream once, front to back, cuts it
into records by their headers, writes every record as a gzip member of its own
and notes its offset and length in an index file beside the archive. Readers
then seek to any record. All files are in the shared folder; names carry the
task attempt and only files named by the written manifest are read, so a lost
executor leaves at most unread files behind.

Payloads equal by SHA-256 and of at least ``min_bytes`` are stored once: the row
with the smallest id is the response, the others are revisits without a block.

Defined cases: null html is an empty payload; a null id is never a group's
smallest while another exists; rows repeated with the smallest id are all
responses; control characters and spaces in a url are percent-encoded in the
header, so the read-back ``target_uri`` is not always the page's url (a null one
is ``urn:page:`` and the id); an empty table gives no archives and no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchcredit.llm.common import Workspace

CHUNK = 1 << 20
#: Uncompressed bytes after which a partition starts another archive.
ARCHIVE_BYTES = 64 << 20
#: Tasks that read archives at most, as a multiple of the shuffle partitions.
READ_TASKS = 4
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record: a response with its HTTP message, or a revisit of ``refers_to``."""
    target = quote(url, safe="%/:?#[]@!$&'()*+,;=~-._", errors="replace") if url else f"urn:page:{page_id}"
    block = b"" if refers_to is not None else HTTP_HEAD + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}",
            f"X-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(raw: bytes) -> tuple[dict[str, str], int]:
    """Header fields by lower-case name, and where the block starts."""
    end = raw.index(b"\r\n\r\n")
    lines = raw[:end].decode("utf-8").split("\r\n")
    return {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}, end + 4


def records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of an inflated stream; holds one record and one chunk at a time."""
    held = bytearray()
    need = None
    for chunk in chunks:
        held += chunk
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                fields, start = headers(bytes(held[:end + 4]))
                need = start + int(fields["content-length"]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held:
        raise ValueError("the archive ends inside a record")


def inflated(stream) -> Iterator[bytes]:
    """Chunks of a gzip stream (of any number of members), inflated once with bounded output."""
    z = zlib.decompressobj(31)
    data = stream.read(CHUNK)
    while data:
        out = z.decompress(data, CHUNK)
        if out:
            yield out
        data = z.unconsumed_tail
        if z.eof:
            data = z.unused_data or stream.read(CHUNK)
            z = zlib.decompressobj(31)
        elif not data:
            data = stream.read(CHUNK)


def gzip_member(raw: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def normalise(fs, source: str, target: str) -> int:
    """Rewrite a gzip archive as one member per record plus ``target``.idx; returns the number of records."""
    n = at = 0
    with fs.open_input_stream(source, compression=None) as src, fs.open_output_stream(target, compression=None) as out, \
            fs.open_output_stream(f"{target}.idx", compression=None) as index:
        for raw in records(inflated(src)):
            member = gzip_member(raw)
            out.write(member)
            fields, _ = headers(raw)
            index.write((json.dumps([at, len(member), fields["warc-record-id"], fields["warc-type"]]) + "\n").encode())
            at += len(member)
            n += 1
    return n


def read_index(fs, archive: str) -> Iterator[tuple[int, int, str, str]]:
    with fs.open_input_stream(f"{archive}.idx", compression=None) as f:
        rest = b""
        while chunk := f.read(CHUNK):
            *lines, rest = (rest + chunk).split(b"\n")
            yield from (tuple(json.loads(x)) for x in lines)


def typed(pages: DataFrame, ws: Workspace, min_bytes: int, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(page_id, url, payload, digest, refers_to) of every row."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"),
                        F.sha2(payload, 256).alias("digest"))
    # groups of equal payloads, as a table of their own: both sides of the join are plain exchanges,
    # so a hot digest's rows can be split over tasks
    groups = ws.keep(base.filter(F.length("payload") >= min_bytes).groupBy(F.col("digest").alias("of_digest"))
                     .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"), "groups")
    return base.join(groups, F.col("digest") == F.col("of_digest"), "left").select(
        "page_id", "url", "payload", "digest",
        F.when(F.col("page_id").eqNullSafe(F.col("first")), F.lit(None)).otherwise(F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, ws: Workspace, min_bytes: int = 100, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """Manifest (archive, records) of the archives written for all rows."""
    folder = f"{ws.root}/warc"
    rows = typed(pages, ws, min_bytes, id_col, url_col, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(folder)
        task = TaskContext.get()
        name = f"{root}/part-{task.partitionId():06d}-{task.taskAttemptId()}"
        stream = z = None
        size = n = 0
        done: list[tuple[str, int]] = []

        def finish() -> None:
            stream.write(z.flush())
            stream.close()
            target = f"{name}-{len(done):04d}.warc.gz"
            count = normalise(fs, f"{name}.mono.gz", target)
            if count != n:
                raise ValueError(f"{n} records written, {count} read")
            fs.delete_file(f"{name}.mono.gz")
            done.append((target, count))

        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if stream is None:
                    fs.create_dir(root, recursive=True)
                    stream, z = fs.open_output_stream(f"{name}.mono.gz", compression=None), zlib.compressobj(1, zlib.DEFLATED, 31)
                    size = n = 0
                raw = record(page_id, url, payload, digest, refers_to)
                stream.write(z.compress(raw))
                size += len(raw)
                n += 1
                if size >= ARCHIVE_BYTES:
                    finish()
                    stream = None
        if stream is not None:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in done], pa.string()), pa.array([c for _, c in done], pa.int64())],
                                         names=["archive", "records"])

    return ws.keep(rows.mapInArrow(run, "archive string, records long"), "manifest")


def open_folder(uri: str):
    """File system and path of the shared folder, as the workers see it."""
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """(page_id, target_uri, payload_bytes, payload_digest, record_type, refers_to) of every record, read by offset.

    Archives are dealt by range of name over as many tasks as there are archives, up to a multiple of the shuffle
    partitions: the manifest is a few rows, which the session would otherwise put into one task.
    """
    spark = manifest.sparkSession
    tasks = max(1, min(manifest.count(), READ_TASKS * int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_folder(folder)
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                rows: list[tuple] = []
                with fs.open_input_file(archive) as f:
                    for at, length, _, _ in read_index(fs, archive):
                        f.seek(at)
                        rows.append(described(zlib.decompress(f.read(length), 31)))
                        if len(rows) >= 2000:
                            yield packed(rows)
                            rows = []
                yield packed(rows)

    return (manifest.select("archive").repartitionByRange(tasks, "archive")
            .mapInArrow(run, "page_id long, target_uri string, payload_bytes long, payload_digest string, record_type string, refers_to long"))


def described(raw: bytes) -> tuple:
    fields, start = headers(raw)
    number = lambda urn: None if urn == "<urn:page:None>" else int(urn[10:-1])
    digest, length = fields["warc-payload-digest"].removeprefix("sha256:"), int(fields["x-payload-length"])
    if fields["warc-type"] == "response":
        payload = raw[start + len(HTTP_HEAD):-4]
        if hashlib.sha256(payload).hexdigest() != digest or len(payload) != length:
            raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
        refers_to = None
    else:
        refers_to = number(fields["warc-refers-to"])
    return number(fields["warc-record-id"]), fields["warc-target-uri"], length, digest, fields["warc-type"], refers_to


def packed(rows: list[tuple]) -> pa.RecordBatch:
    names = ["page_id", "target_uri", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def archive_round_trip(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """Write archives of all rows, then describe every record read back from them."""
    ws = Workspace(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, ws, min_bytes), f"{ws.root}/warc")
