"""WARC archives: a writer with revisit records and a sequential reader.

Each record is a gzip member of its own.  The writer runs in tasks: a task
writes its rows to archives of at most ``max_bytes`` in the shared folder and
returns their list, which is kept as a table.  An archive is first written
under a name of its own attempt and then renamed, so a task that runs again
replaces it by an equal one and readers never meet half an archive.

The reader takes an archive from start to end in blocks: incremental zlib
decompression, a new decompressor where a member ends, header lines up to the
empty line, exactly Content-Length bytes of content and the two line ends.
Payloads are hashed on the way and compared with the record's digest; a
damaged or truncated archive raises ``WarcError``.

Records with equal payloads of ``min_revisit`` bytes or more share one
response, that of the smallest page id; the others are revisit records without
payload, which name that response and keep the full payload's digest and size.

Defined cases: a null text is an empty payload, a null url an empty target; a
null page id is kept as such, counts as the largest, and stays a response; rows
that repeat the smallest page id with the same payload are all responses; extra
columns are ignored; an empty table gives no archives and no records.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.arrowtext import small_batches
from shelfwise.llm.common import written
from shelfwise.session import app_id, shared_dir

BLOCK = 1 << 16
#: Record form and the profile of a revisit by equal payload.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

RECORDS = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
           "archive string, position long")


class WarcError(ValueError):
    """An archive that isn't well formed, or a payload that doesn't match its digest."""


def _filesystem(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(value: str) -> int | None:
    n = value.removeprefix("<urn:page:").removesuffix(">")
    return int(n) if n else None


def member(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member."""
    revisit = refers_to is not None
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)),
            ("WARC-Date", DATE), ("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")),
            ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(len(payload)))]
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    body = b"" if revisit else payload
    head += [("Content-Type", "text/html"), ("Content-Length", str(len(body)))]
    raw = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + body + b"\r\n\r\n"
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


class _Members:
    """Reads bytes of one gzip member after another from a stream, in blocks."""

    def __init__(self, f: BinaryIO):
        self.f, self.rest, self.buf, self.z = f, b"", bytearray(), None

    def open(self) -> bool:
        """Starts the next member; False at the end of the stream."""
        if not self.rest:
            self.rest = self.f.read(BLOCK)
        if not self.rest:
            return False
        self.z = zlib.decompressobj(31)
        return True

    def more(self) -> bool:
        """Takes some more bytes of the member; False at its end."""
        if self.z.eof:
            return False
        block = self.z.unconsumed_tail or self.rest or self.f.read(BLOCK)
        try:
            out = self.z.decompress(block, BLOCK)
        except zlib.error as e:
            raise WarcError(f"bad compressed data: {e}") from e
        if not block and not out and not self.z.eof:
            raise WarcError("the archive ends within a record")
        # What follows the member belongs to the next one.
        self.rest = self.z.unused_data if self.z.eof else b""
        self.buf += out
        return True

    def line(self) -> bytes:
        while (at := self.buf.find(b"\r\n")) < 0:
            if not self.more():
                raise WarcError("the header isn't ended")
        out = bytes(self.buf[:at])
        del self.buf[: at + 2]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        """Exactly ``n`` bytes, in parts."""
        while n:
            if not self.buf and not self.more():
                raise WarcError("the content is shorter than its length says")
            part = bytes(self.buf[:n])
            del self.buf[: len(part)]
            n -= len(part)
            if part:
                yield part

    def close(self) -> None:
        """Reads the member's end: two line ends and nothing else."""
        while self.more():
            pass
        if bytes(self.buf) != b"\r\n\r\n":
            raise WarcError("the record isn't followed by two line ends")
        self.buf.clear()


def read_records(f: BinaryIO, payloads: bool = False) -> Iterator[tuple[dict[str, str], bytes | None, int, str]]:
    """(headers, payload if asked for, its size, its SHA-256) of each record, in order."""
    m = _Members(f)
    while m.open():
        if m.line() != VERSION:
            raise WarcError("not a WARC record")
        head: dict[str, str] = {}
        while line := m.line():
            k, sep, v = line.decode().partition(": ")
            if not sep:
                raise WarcError(f"bad header line {line!r}")
            head[k] = v
        sha, size, kept = hashlib.sha256(), 0, bytearray() if payloads else None
        try:
            length = int(head["Content-Length"])
        except (KeyError, ValueError) as e:
            raise WarcError("no content length") from e
        for part in m.take(length):
            sha.update(part)
            size += len(part)
            if kept is not None:
                kept += part
        m.close()
        if head.get("WARC-Type") == "response":
            if head.get("WARC-Payload-Digest") != f"sha256:{sha.hexdigest()}":
                raise WarcError(f"the digest of {head.get('WARC-Record-ID')} doesn't match")
        yield head, bytes(kept) if kept is not None else None, size, sha.hexdigest()


def plan(pages: DataFrame, min_revisit: int = 100, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, refers_to): refers_to is null for responses."""
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                     F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("payload"))
    p = p.withColumn("digest", F.sha2("payload", 256))
    big = p.where(F.length("payload") >= min_revisit)
    first = big.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL")
    out = p.join(first.select("digest", "first"), "digest", "left")
    again = F.col("first").isNotNull() & F.coalesce(F.col("page_id") != F.col("first"), F.lit(False))
    return out.select("page_id", "url", "payload", "digest", F.when(again & (F.length("payload") >= min_revisit), F.col("first")).alias("refers_to"))


def write(spark: SparkSession, planned: DataFrame, folder: str | None = None, max_bytes: int = 64 << 20) -> DataFrame:
    """Writes the archives; (archive, records, bytes) of each, as a written table."""
    small_batches(spark)
    folder = folder or shared_dir(spark, "llm", app_id(spark), f"warc-{uuid.uuid4().hex[:12]}")

    def run(batches):
        fs, root = _filesystem(folder)
        fs.create_dir(root, recursive=True)
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        out, n, size, seq = None, 0, 0, 0
        done = []

        def end():
            nonlocal out, seq
            if out is not None:
                out.close()
                final = f"{root}/part-{part:06d}-{seq:04d}.warc.gz"
                fs.move(tmp(), final)
                done.append((f"part-{part:06d}-{seq:04d}.warc.gz", n, size))
                out, seq = None, seq + 1

        def tmp():
            return f"{root}/.part-{part:06d}-{seq:04d}.{attempt}"

        for batch in batches:
            for page, url, payload, digest, ref in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                raw = member(page.as_py(), url.as_py(), payload.as_py(), digest.as_py(), ref.as_py())
                if out is not None and size + len(raw) > max_bytes:
                    end()
                if out is None:
                    out, n, size = fs.open_output_stream(tmp(), compression=None), 0, 0
                out.write(raw)
                n, size = n + 1, size + len(raw)
        end()
        names, counts, sizes = zip(*done) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{x}" for x in names], pa.string()), pa.array(counts, pa.int64()),
                                          pa.array(sizes, pa.int64())], names=["archive", "records", "bytes"])

    return written(spark, planned.mapInArrow(run, "archive string, records long, bytes long"), "warc-list")


def read(archives: DataFrame) -> DataFrame:
    """The records of all listed archives; one task reads an archive from start to end."""
    def run(batches):
        for batch in batches:
            for uri in batch.column("archive").to_pylist():
                fs, path = _filesystem(uri)
                rows = []
                with fs.open_input_stream(path, compression=None) as f:
                    for at, (head, _, size, sha) in enumerate(read_records(f)):
                        kind = head["WARC-Type"]
                        whole = kind == "response"
                        rows.append((page_of(head["WARC-Record-ID"]), head["WARC-Target-URI"], kind,
                                     None if whole else page_of(head["WARC-Refers-To"]),
                                     size if whole else int(head["X-Payload-Length"]),
                                     sha if whole else head["WARC-Payload-Digest"].removeprefix("sha256:"), uri, at))
                        if len(rows) >= 10_000:
                            yield _batch(rows)
                            rows = []
                yield _batch(rows)

    n = archives.count()
    return archives.select("archive").repartition(max(1, n)).mapInArrow(run, RECORDS)


_TYPES = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
_NAMES = [x.split()[0] for x in RECORDS.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(_TYPES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES)], names=_NAMES)
