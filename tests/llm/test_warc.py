"""WARC: full round trips, framing faults, and the rules for revisits."""

import gzip
import hashlib
import io
import random
import zlib

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import warc


def archive(payloads):
    return b"".join(warc.member(i, f"http://x/{i}", p, hashlib.sha256(p).hexdigest(), None) for i, p in enumerate(payloads))


class Slow(io.RawIOBase):
    """A stream that gives a few bytes at a time."""

    def __init__(self, raw):
        self.raw, self.at, self.r = raw, 0, random.Random(3)

    def read(self, n=-1):
        n = self.r.randint(1, 7)
        out = self.raw[self.at: self.at + n]
        self.at += len(out)
        return out


PAYLOADS = [b"", b"x", "é▁\r\n\r\nWARC/1.1\r\n".encode() * 50, bytes(range(256)) * 3000, b"\x1f\x8b\x08" * 40, random.Random(1).randbytes(200_000)]


@pytest.mark.parametrize("stream", [io.BytesIO, Slow])
def test_round_trip(stream):
    raw = archive(PAYLOADS[:4] + PAYLOADS[4:5] if stream is Slow else PAYLOADS)
    got = list(warc.read_records(stream(raw), payloads=True))
    assert [p for _, p, _, _ in got] == (PAYLOADS[:5] if stream is Slow else PAYLOADS)
    assert [h["WARC-Record-ID"] for h, *_ in got] == [f"<urn:page:{i}>" for i in range(len(got))]


def test_members_are_gzip_records():
    raw = archive([b"abc"])
    assert gzip.decompress(raw).endswith(b"\r\n\r\nabc\r\n\r\n")
    assert list(warc.read_records(io.BytesIO(b""))) == []


def remake(change):
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(change(gzip.decompress(archive([b"hello" * 50])))) + z.flush()


@pytest.mark.parametrize("raw", [
    archive([b"abc" * 100])[:-9], archive([b"abc" * 100])[:40], b"no archive at all", remake(lambda x: x.replace(b"hellohello", b"hellojello", 1)),
    remake(lambda x: x.replace(b"Content-Length: 250", b"Content-Length: 251")), remake(lambda x: x.replace(b"Content-Length: 250", b"Content-Length: 2")),
    remake(lambda x: x.replace(b"Content-Length: 250\r\n", b"")), remake(lambda x: x[:-2]), remake(lambda x: x.replace(b"WARC/1.1", b"WARC/9.9")),
    remake(lambda x: x.replace(b"WARC-Type: ", b"WARC-Type"))])
def test_faults_are_found(raw):
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(raw)))


def test_tables(spark):
    big, other = "b" * 100, "é" * 50
    rows = [(5, "u", big), (3, "u", big), (9, None, big), (3, "again", big), (1, "u\r\nX: y", "b" * 99), (2, "u", "b" * 99), (4, "u", None), (6, "u", ""),
            (7, "u", other), (8, "u", other), (None, "u", other), (10, "u", "z" * 3_000_000), (11, "ü", "only")]
    df = spark.createDataFrame([(*r, "d", 1) for r in rows], "page_id long, url string, html string, digest string, payload int")
    archives = warc.write(spark, warc.plan(df), max_bytes=400)
    assert archives.count() > 3 and archives.agg(F.sum("records")).first()[0] == len(rows)
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in warc.read(archives).collect()), key=str)
    exp = []
    for page, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == raw and p is not None]
        first = min(same) if same and len(raw) >= 100 else None
        again = first is not None and page is not None and page != first
        exp.append((page, "revisit" if again else "response", first if again else None, len(raw), hashlib.sha256(raw).hexdigest()))
    assert got == sorted(exp, key=str)
    assert warc.read(warc.write(spark, warc.plan(df.limit(0)))).count() == 0
