import base64
import gzip
import hashlib
import random
import zlib

import pytest

from refloom.llm import warc as W
from refloom.llm.common import work_path


def rows():
    r = random.Random(1)
    pages = [None, "", "same", "same", "é" * 500, "x" * 100_000, "".join(chr(r.randrange(32, 0x300)) for _ in range(3000)), "\r\n\r\nWARC/1.1\r\n"]
    out = [(i, f"http://x/{i}\n {chr(7)}é", p) for i, p in enumerate(pages * 3)]
    return out + [(None, None, "same"), (None, None, "only null"), (23, "again", pages[-1])]


@pytest.mark.parametrize(("range_bytes", "least"), [(1 << 20, 0), (37, 0), (300, 5)])
def test_round_trip(spark, range_bytes, least):
    df = spark.createDataFrame([(*x, 1) for x in rows()], "page_id long, url string, html string, sha int").repartition(3)
    path = work_path(spark, "w")
    W.write_warc(df, path, min_bytes=least, records_per_file=7)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload if r.payload is None else bytes(r.payload)) for r in W.read_warc(spark, path, range_bytes).collect()), key=str)
    want = []
    for i, _, p in rows():
        data = (p or "").encode()
        top = max((j for j, _, q in rows() if (q or "") == (p or "") and j is not None), default=None)
        revisit = i != top and len(data) >= least
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", top if revisit else None, None if revisit else data))
    assert got == sorted(want, key=str)


def test_files_are_plain_gzip(spark):
    path = work_path(spark, "w")
    W.write_warc(spark.createDataFrame([(1, "u", "a"), (2, "u", "b" * 1000)], "page_id long, url string, html string").coalesce(1), path)
    data = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect())
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 2


def test_large_records_and_false_magic(tmp_path):
    big = W._record(1, "u", bytes(17 << 20), "A" * 32, None, True)
    assert big[-1] == 0
    payload = b"z" * (17 << 20)
    digest = W.base32(hashlib.sha1(payload).hexdigest())
    large = W._record(2, "u", payload, digest, None, False)
    assert large.endswith(W.EMPTY_MEMBER) and zlib.decompress(large, 31)[-4:] == b"\r\n\r\n"
    file = tmp_path / "x.warc.gz"
    file.write_bytes(W.MAGIC * 5 + b"noise" + large + W._record(3, None, b"q", W.base32(hashlib.sha1(b"q").hexdigest()), None, False))
    size = file.stat().st_size
    for step in (size, 1000):
        found = [r[0] for a in range(0, size, step) for r in W.read_range(f"file://{file}", a, min(size, a + step))]
        assert found == ["2", "3"]


def test_empty(spark):
    path = work_path(spark, "w")
    W.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert W.read_warc(spark, path).count() == 0


def member(kind, fields, block, length=None):
    head = ["WARC/1.0", f"WARC-Type: {kind}", *fields, f"content-length: {len(block) if length is None else length}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def test_archives_of_others(spark, tmp_path):
    """Kinds that are no pages, records without digests or with other ones, folded lines, ids that are no numbers, a cut last member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\npage"
    cut = member("response", ["WARC-Record-ID: <urn:uuid:9>"], http)
    file = tmp_path / "x.warc.gz"
    file.write_bytes(
        member("warcinfo", ["WARC-Record-ID: <urn:uuid:0>", "WARC-Filename: x"], b"software: y\r\n")
        + member("request", ["WARC-Record-ID: <urn:uuid:1>"], b"GET / HTTP/1.1\r\n\r\n")
        + member("response", ["WARC-Record-ID: <urn:uuid:2>", "WARC-Target-URI: http://a/", " b", "Content-Type: application/http; msgtype=response"], http)
        + member("metadata", ["WARC-Record-ID: <urn:uuid:3>"], b"x: y")
        + member("response", ["WARC-Record-ID: <urn:uuid:4>", "WARC-Payload-Digest: sha1:" + W.base32(hashlib.sha1(b"page").hexdigest())], http)
        + member("response", ["WARC-Payload-Digest: sha256:00ff"], http)
        + member("resource", ["WARC-Record-ID: <urn:uuid:5>", "Content-Type: text/plain"], b"a\r\n\r\nb")
        + member("revisit", ["WARC-Record-ID: <urn:uuid:6>", "WARC-Refers-To: <urn:uuid:2>"], b"HTTP/1.1 304 Not Modified\r\n\r\n")
        + W._record(7, "u", b"ours", W.base32(hashlib.sha1(b"ours").hexdigest()), None, False)
        + cut[: len(cut) // 2]
    )
    ours = W.base32(hashlib.sha1(b"ours").hexdigest())
    want = [
        ("urn:uuid:2", "http://a/ b", "response", 4, None, None, b"page"),
        ("urn:uuid:4", None, "response", 4, W.base32(hashlib.sha1(b"page").hexdigest()), None, b"page"),
        (None, None, "response", 4, "sha256:00ff", None, b"page"),
        ("urn:uuid:5", None, "resource", 6, None, None, b"a\r\n\r\nb"),
        ("urn:uuid:6", None, "revisit", None, None, "urn:uuid:2", None),
        ("7", "u", "response", 4, ours, None, b"ours"),
    ]
    for step in (1 << 20, 150):
        got = [tuple(None if v is None else bytes(v) if isinstance(v, bytearray) else v for v in r) for r in W.read_warc(spark, f"file://{file}", step, id_type="string").collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert [r.page_id for r in W.read_warc(spark, f"file://{file}").where("page_id is not null").collect()] == [7]
    broken = tmp_path / "y.warc.gz"
    broken.write_bytes(member("response", ["WARC-Payload-Digest: sha1:" + "A" * 32], http))
    with pytest.raises(ValueError, match="digest"):
        list(W.read_range(f"file://{broken}", 0, broken.stat().st_size))
