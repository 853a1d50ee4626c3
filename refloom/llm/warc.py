"""WARC archives: a writer with revisit records, and a splittable reader.

Every record is a gzip member of its own. The writer hands the members to Spark's text sink with a NUL as line
separator: the last byte of a member is the high byte of its uncompressed size, which is NUL under 16 MB (larger records
are followed by an empty member, which ends in NULs), so the sink's separator is that last byte and the files are plain
multi-member gzip. Spark's own commit protocol then covers lost executors and any file system.

The reader deals out byte ranges of the files. A task scans its range for the gzip magic, takes a candidate for a member
if it decodes to a WARC version line and header block, and owns the records whose first byte lies in its range; the last
may end in the next range.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import over_rows, read_table, work_path
from .simhash import _arrow_type

MAGIC = b"\x1f\x8b\x08"
RANGE = 4 << 20
LOOK = 1 << 16
BATCH = 4 << 20  # bytes of payload that are returned at a time, and one record
PAGES = ("response", "resource", "conversion", "revisit")
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EMPTY_MEMBER = MAGIC + bytes(6) + b"\xff" + b"\x03\x00" + bytes(8)


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    out = packer.compress(data) + packer.flush()
    return out if out[-1] == 0 else out + EMPTY_MEMBER


def _record(page_id, url, payload: bytes, digest: str, keeper, revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = lambda i: f"<urn:x-page:{'null' if i is None else i}>"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Refers-To: {name(keeper)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return _member("\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n")


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, records_per_file: int = 20000) -> None:
    """A record for each row. Of rows with equal payloads of at least min_bytes bytes, that with the largest id is a
    response and the others revisit it; shorter payloads are all responses.

    Null payloads count as empty. Rows that repeat with the largest id are all responses. Null ids come before all
    others; the record's id is then `null`. Null urls have no target. No rows: no records.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    keepers = rows.groupBy("sha").agg(F.max("id").alias("keeper"))
    joined = rows.join(keepers, "sha").withColumn("revisit", ~F.col("id").eqNullSafe(F.col("keeper")) & (F.octet_length("payload") >= min_bytes))
    schema = pa.schema([("value", pa.binary())])

    def make(cols: dict[str, list]) -> dict[str, object]:
        return {"value": [_record(i, u, p, base32(s), k, r)[:-1] for i, u, p, s, k, r in zip(*(cols[c] for c in ("id", "url", "payload", "sha", "keeper", "revisit")))]}

    members = joined.mapInArrow(over_rows(make, schema), "value binary").select(F.col("value").cast("string"))
    members.write.option("lineSep", "\0").option("maxRecordsPerFile", records_per_file).text(path)


def _decode(read, at: int, data: bytes) -> tuple[bytes, int] | None:
    """The member at the start of data (read(at, n) gives more), and its length; None if there is none."""
    unpack, out, used = zlib.decompressobj(31), [], 0
    while True:
        try:
            out.append(unpack.decompress(data))
        except zlib.error:
            return None
        used += len(data)
        if not used or len(out[0]) >= 7 and not out[0].startswith(b"WARC/1."):
            return None
        if unpack.eof:
            return b"".join(out), used - len(unpack.unused_data)
        data = read(at + used, 1 << 20)
        if not data:
            return None


def _fields(lines: list[str]) -> dict[str, str]:
    """Header fields by lower-case name; folded lines belong to the one before."""
    out: dict[str, str] = {}
    name = None
    for line in lines:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def _number(told: str | None) -> int | None:
    return int(told) if told is not None and told.isdecimal() else None


def _parse(record: bytes) -> tuple | None:
    """What a record says; () of a record that is no page (warcinfo, request, metadata), None if it is no WARC record.

    Fields that a record lacks are null. A payload is held against its digest if that is a whole SHA-1 and nothing was truncated.
    """
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogateescape").split("\r\n")
    if not gap or not lines[0].startswith("WARC/1."):
        return None
    fields = _fields(lines[1:])
    kind = fields.get("warc-type", "").lower()
    if kind not in PAGES:
        return ()
    length = _number(fields.get("content-length"))
    block = rest[:length] if length is not None else rest.removesuffix(b"\r\n\r\n")
    payload = block
    if kind == "revisit" or fields.get("content-type", "application/http").lower().startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields.get("warc-payload-digest")
    bare = digest[5:].upper() if digest and digest.lower().startswith("sha1:") else digest
    if kind == "revisit":
        size, payload = _number(_fields(http.decode("latin-1").split("\r\n")[1:]).get("content-length")), None
    else:
        size = len(payload)
        if bare != digest and len(bare) == 32 and "warc-truncated" not in fields and base64.b32encode(hashlib.sha1(payload).digest()).decode() != bare:
            raise ValueError(f"payload digest differs in {fields.get('warc-record-id')}")
    return _page(fields.get("warc-record-id")), fields.get("warc-target-uri"), kind, size, bare, _page(fields.get("warc-refers-to")), payload


def _page(name: str | None) -> str | None:
    """The id in a record's name: that of a page of ours, else what stands between the brackets."""
    if name is None or name == "<urn:x-page:null>":
        return None
    return name[len("<urn:x-page:") : -1] if name.startswith("<urn:x-page:") else name.removeprefix("<").removesuffix(">")


def read_range(path: str, start: int, end: int) -> Iterator[tuple]:
    """The records whose first byte is in [start, end) of one file, in order."""
    from pyarrow.fs import FileSystem

    system, name = FileSystem.from_uri(path)
    with system.open_input_file(name) as file:
        read = lambda at, n: file.read_at(n, at) if at < file.size() else b""
        data, at = read(start, end - start + len(MAGIC) - 1), 0
        while (at := data.find(MAGIC, at)) >= 0 and start + at < end:
            found = _decode(read, start + at, data[at : at + LOOK])
            record = _parse(found[0]) if found else None
            if record:
                yield record
            at += 1 if record is None else found[1]


def read_warc(spark: SparkSession, path: str, range_bytes: int = RANGE, with_payload: bool = True, id_type: str = "long") -> DataFrame:
    """(page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload) for each response, resource, conversion and revisit.

    Records of other kinds are passed over, and so is a last member that is cut off. Fields that a record lacks are null; so are
    the payload of a revisit, and ids that are not of id_type (read archives of others with id_type="string").
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    ranges = files.where("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    schema = pa.schema([("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, length, start in zip(*(c.to_pylist() for c in batch.columns)):
                held: list[tuple] = []
                size = 0
                for record in read_range(name, start, min(length, start + range_bytes)):
                    held.append(record if with_payload else (*record[:-1], None))
                    size += len(held[-1][-1] or b"")
                    if len(held) == 256 or size >= BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    read = ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "start").mapInArrow(run, "page_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary")
    return read.withColumns({c: F.col(c).try_cast(id_type) for c in ("page_id", "refers_to")})


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "warc")
    write_warc(read_table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = """
SELECT page_id, strlen(p) AS payload_bytes,
  (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS INTEGER) >> (15 - 5 * (i % 4))) & 31), 1), '' ORDER BY i) FROM range(32) t(i)) AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS p, sha1(coalesce(html, '')) AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages)
"""
