"""WARC archives: from one gzip stream per file to one gzip member per record (operator 2).

``write_archives`` writes records as archives that are gzipped as a whole. Such a
file can only be read from its start. ``normalise`` inflates each of them once, as
a stream, writes every record as a gzip member of its own and returns the index
of the members; ``index`` keeps it as a table beside the archives. With it
``read_records`` fetches any records by offset.

Archives are files in a shared folder, of about ``ARCHIVE_BYTES`` before
compression. Every attempt of a task writes files of its own name, and only the
files of the attempt that Spark accepted are listed, so lost tasks leave at most
unlisted files. A task holds one record's header and one piece of its block, or
in ``read_records`` one record.

Records with equal payloads of ``least_bytes`` or more are one response, that
with the largest id, and revisits of it. The search for equal payloads groups
digests with a map-side maximum, and the join back is an equi-join whose hot
digests adaptive execution splits; smaller payloads have join keys of their own.

Cases: null text is an empty payload. Null ids make records without an id; they
are never referred to unless all ids of a payload are null, and then all are
responses. Repeated rows with the largest id are all responses. White space and
control characters of a URL are percent-encoded, a null URL is left out. An empty
table gives no archive. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellurion.llm.common import staged

LEAST_BYTES = 1000
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 20
LEVEL = 6
#: Format values of WARC 1.1.
VERSION = "WARC/1.1"
RECORD_URN = "urn:x-page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = ("record_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to")
INDEX = (
    "archive string, offset long, length long, record_id long, record_type string,"
    " target_uri string, payload_digest string"
)
READ = (
    "record_id long, record_type string, refers_to long, target_uri string,"
    " payload_bytes long, payload_digest string, payload binary"
)


def records(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    text_col: str = "html",
    least_bytes: int = LEAST_BYTES,
) -> DataFrame:
    """One record per row: payload, digest, and whether it is a response or a revisit."""
    payload = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_col).cast("long").alias("record_id"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumns(
        {
            "payload_bytes": F.octet_length("payload").cast("long"),
            "payload_digest": F.sha1("payload"),
        }
    )
    large = F.col("payload_bytes") >= least_bytes
    kept = (
        rows.where(large)
        .groupBy(F.col("payload_digest").alias("shared"))
        .agg(F.max("record_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 and first_id is not null")
        .drop("copies")
    )
    own_key = F.concat(F.lit("-"), F.coalesce(F.col("record_id").cast("string"), F.lit("")))
    joined = rows.withColumn("shared", F.when(large, F.col("payload_digest")).otherwise(own_key))
    joined = joined.join(kept, "shared", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("record_id").eqNullSafe(F.col("first_id"))
    return joined.withColumns(
        {
            "record_type": F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
            "refers_to": F.when(revisit, F.col("first_id")),
        }
    ).select(*RECORDS)


def _uri(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def _record(row: dict) -> bytes:
    """A WARC record with its block; a revisit has the HTTP head alone."""
    revisit = row["record_type"] == "revisit"
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    block = head if revisit else head + row["payload"]
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    lines = [VERSION, f"WARC-Type: {row['record_type']}"]
    if row["record_id"] is not None:
        lines.append(f"WARC-Record-ID: <{RECORD_URN}{row['record_id']}>")
    if row["url"] is not None:
        lines.append(f"WARC-Target-URI: {_uri(row['url'])}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{RECORD_URN}{row['refers_to']}>"]
    lines += [
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip(level: int):
    return zlib.compressobj(level, zlib.DEFLATED, 31)


def _create(folder: str, name: str):
    """An output stream for a new file of the folder, and the file's path."""
    files, root = pyarrow.fs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)
    return files.open_output_stream(f"{root}/{name}", compression=None), f"{folder}/{name}"


def write_archives(
    rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, level: int = LEVEL
) -> DataFrame:
    """Write records to archives of one gzip stream each; returns their paths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        stem = f"{context.partitionId():06d}-{context.taskAttemptId()}"
        out, path, size, count, made = None, "", 0, 0, 0
        for batch in batches:
            for k in range(batch.num_rows):
                if out is None:
                    out, path = _create(folder, f"{stem}-{made:05d}.warc.gz")
                    stream, size, count, made = _gzip(level), 0, 0, made + 1
                data = _record({n: batch.column(n)[k].as_py() for n in RECORDS})
                out.write(stream.compress(data))
                size, count = size + len(data), count + 1
                if size >= archive_bytes:
                    out.write(stream.flush())
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"archive": [path], "records": [count]})
        if out is not None:
            out.write(stream.flush())
            out.close()
            yield pa.RecordBatch.from_pydict({"archive": [path], "records": [count]})

    return staged(rows.mapInArrow(run, "archive string, records long"), "archives")


class _Inflated:
    """Bytes of a gzip file, inflated as they are asked for; members may follow each other."""

    def __init__(self, source):
        self.source, self.inflate, self.buffer = source, zlib.decompressobj(31), b""

    def _more(self) -> bool:
        data = self.inflate.unconsumed_tail or self.inflate.unused_data
        if self.inflate.eof:
            self.inflate = zlib.decompressobj(31)
        data = data or self.source.read(CHUNK)
        if not data:
            return False
        self.buffer += self.inflate.decompress(data, CHUNK)
        return True

    def head(self) -> bytes | None:
        """The header of the next record, up to its empty line; None at the end."""
        searched = 0
        while (end := self.buffer.find(b"\r\n\r\n", searched)) < 0:
            searched = max(0, len(self.buffer) - 3)
            if not self._more():
                if self.buffer.strip():
                    raise ValueError("archive ends within the header of a record")
                return None
        head, self.buffer = self.buffer[: end + 4], self.buffer[end + 4 :]
        return head

    def parts(self, length: int) -> Iterator[bytes]:
        """The next ``length`` bytes, in pieces."""
        while length:
            if not self.buffer and not self._more():
                raise ValueError("archive ends within a record")
            part, self.buffer = self.buffer[:length], self.buffer[length:]
            length -= len(part)
            yield part


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    pairs = (line.split(":", 1) for line in lines[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def _number(urn: str | None) -> int | None:
    return int(urn.strip("<>").removeprefix(RECORD_URN)) if urn else None


def _hex_digest(value: str | None) -> str | None:
    return base64.b32decode(value.removeprefix("sha1:")).hex() if value else None


def normalise(archives: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """Rewrite each archive with one gzip member per record; returns the index of members."""

    def rewrite(path: str, name: str) -> dict[str, list]:
        files, root = pyarrow.fs.FileSystem.from_uri(path)
        rows: dict[str, list] = {c.split()[0]: [] for c in INDEX.split(", ")}
        offset = 0
        with files.open_input_stream(root, compression=None) as source:
            stream = _Inflated(source)
            out, target = _create(folder, name)
            with out:
                while (head := stream.head()) is not None:
                    fields = _fields(head)
                    member = _gzip(level)
                    done = out.write(member.compress(head))
                    for part in stream.parts(int(fields["content-length"])):
                        done += out.write(member.compress(part))
                    ending = b"".join(stream.parts(4))
                    done += out.write(member.compress(ending)) + out.write(member.flush())
                    values = (
                        target, offset, done, _number(fields.get("warc-record-id")),
                        fields["warc-type"], fields.get("warc-target-uri"),
                        _hex_digest(fields.get("warc-payload-digest")),
                    )
                    for column, value in zip(rows.values(), values):
                        column.append(value)
                    offset += done
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for path in batch.column("archive").to_pylist():
                name = path.rsplit("/", 1)[-1].removesuffix(".warc.gz")
                found = rewrite(path, f"{name}-{attempt}.records.warc.gz")
                yield pa.RecordBatch.from_pydict(found, pa.schema([
                    ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                    ("record_id", pa.int64()), ("record_type", pa.string()),
                    ("target_uri", pa.string()), ("payload_digest", pa.string()),
                ]))

    # A task per archive: their number is known and each is of bounded size.
    spread = archives.select("archive").repartition(max(1, archives.count()), "archive")
    return spread.mapInArrow(run, INDEX)


def index(archives: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """Normalise the archives and keep the index as a table beside them."""
    normalise(archives, folder, level).write.parquet(f"{folder}/index")
    return archives.sparkSession.read.parquet(f"{folder}/index")


def _parsed(data: bytes) -> tuple:
    data = zlib.decompress(data, 31)
    head, rest = data.split(b"\r\n\r\n", 1)
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    revisit = fields["warc-type"] == "revisit"
    full = int(_fields(http)["content-length"]) if revisit else len(payload)
    named = _hex_digest(fields.get("warc-payload-digest"))
    digest = named if revisit else hashlib.sha1(payload).hexdigest()
    if digest != named:
        raise ValueError(f"payload of {fields.get('warc-record-id')} does not match its digest")
    return (
        _number(fields.get("warc-record-id")), fields["warc-type"],
        _number(fields.get("warc-refers-to")), fields.get("warc-target-uri"), full, digest,
        None if revisit else payload,
    )


def read_records(members: DataFrame) -> DataFrame:
    """Records of index rows, each read at its offset; neighbours share a read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file, at, held = None, None, 0, b""
        schema = pa.schema([
            ("record_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
            ("target_uri", pa.string()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("payload", pa.binary()),
        ])
        for batch in batches:
            rows, size = [], 0
            for archive, offset, length in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if archive != path:
                    files, root = pyarrow.fs.FileSystem.from_uri(archive)
                    path, file, held = archive, files.open_input_file(root), b""
                if not at <= offset <= offset + length <= at + len(held):
                    file.seek(offset)
                    at, held = offset, file.read(max(length, CHUNK))
                rows.append(_parsed(held[offset - at : offset - at + length]))
                size += rows[-1][4]
                if size > 4 * CHUNK:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)
                    rows, size = [], 0
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)

    return members.select("archive", "offset", "length").mapInArrow(run, READ)

