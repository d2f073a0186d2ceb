"""WARC archives: a writer, and a salvage reader that survives damage.

Writing: every record is one gzip member (or plain bytes), made in the tasks that
hold the pages and appended by Spark's own text writer, so archives go to any
store that Spark can write.  Payloads of at least ``MIN_REVISIT`` bytes that are equal are written once, as the
response with the largest page id; the others become revisits that refer to it.
An archive is bounded by records and by payload bytes, so a reader task holds one archive of
bounded size at a time: records are written by classes of payload size, and the longer the payloads of a
class, the fewer records an archive of it holds.  Where no payload is above the first
class's bound there is one write.

Reading: every record is checked (member CRC, version line, header block, content
length, closing blank lines, payload digest).  After a failed check the reader
looks for the next gzip member or version line that starts a valid record, whatever
byte comes before it, goes on from there, and logs the skipped bytes as a quarantined
gap.  A member that holds several records (an archive compressed as one stream) is
salvaged like plain bytes: its records and gaps have the offset and length of the
member, and the reason of a gap names the inflated bytes.  A member that fails its CRC
or is cut stays one gap.

Defined cases: a null payload is empty; a null url is written as an empty target;
null page ids are ignored when the largest id is sought, and rows that repeat the
response's id and payload are responses too; a payload of any length is one record,
built and read in the memory of its task; an empty table writes no archive
and reads as no record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from inkwell.llm.common import checkpoint

MIN_REVISIT = 1000
RECORDS_PER_FILE = 2000
CLASS_BYTES, CLASS_STEP = 1 << 18, 16  # payloads of the first class; how much longer those of the next class are
_END = b"\r\n\r\n"
_MEMBER = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_START = re.compile(rb"\x1f\x8b\x08|" + _VERSION.pattern)
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_SCHEMA = ("archive string, offset long, length long, kind string, reason string, record_type string, record_id string, "
               "target string, payload_bytes long, payload_digest string, refers_to string")


def _id(page_id) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def build_record(page_id, url: str | None, payload: bytes, digest_hex: str, refers_to=None, revisit: bool = False,
                 compress: bool = True) -> bytes:
    """One WARC/1.1 record without its last byte pair's separator; gzip member if ``compress``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    digest = base64.b32encode(bytes.fromhex(digest_hex)).decode()
    target = re.sub(r"[\r\n]", "", url or "")
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_id(page_id)}",
            "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += [f"WARC-Profile: {_REVISIT_PROFILE}", f"WARC-Refers-To: {_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block
    if not compress:
        return raw
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(raw + _END) + c.flush()


def parse_record(data: bytes, at: int) -> tuple[dict, int]:
    """The plain record at ``at`` and the offset behind it; ValueError names the failed check."""
    if not _VERSION.match(data, at):
        raise ValueError("version line")
    # Line by line: a false start among damaged bytes ends at its first line that is no header.
    head, line_end = {}, data.find(b"\r\n", at)
    while True:
        start, line_end = line_end + 2, data.find(b"\r\n", line_end + 2) if line_end >= 0 else -1
        if line_end < 0:
            raise ValueError("header block")
        if line_end == start:
            break
        name, sep, value = data[start:line_end].partition(b":")
        if not sep:
            raise ValueError("header line")
        head[name.strip().lower()] = value.strip()
    stop = start - 2
    length = head.get(b"content-length", b"")
    if not length.isdigit() or b"warc-type" not in head or b"warc-record-id" not in head:
        raise ValueError("required header")
    begin = stop + 4
    end = begin + int(length)
    if data[end:end + 4] != _END:
        raise ValueError("content length")
    kind = head[b"warc-type"].decode("utf-8", "replace")
    http, sep, payload = data[begin:end].partition(_END)
    if not head.get(b"content-type", b"").startswith(b"application/http"):
        http, payload = b"", data[begin:end]
    size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    said = head.get(b"warc-payload-digest", b"").decode("utf-8", "replace")
    if said.startswith("sha1:"):
        try:
            said = base64.b32decode(said[5:]).hex()
        except ValueError:
            raise ValueError("payload digest") from None
        if kind == "revisit":
            digest = said
        elif said != digest:
            raise ValueError("payload digest")
    if kind == "revisit":
        m = re.search(rb"(?im)^content-length:\s*(\d+)", http)
        size = int(m[1]) if m else None
    text = {k: v.decode("utf-8", "replace") for k, v in head.items()}
    return {"record_type": kind, "record_id": text[b"warc-record-id"], "target": text.get(b"warc-target-uri"),
            "payload_bytes": size, "payload_digest": digest, "refers_to": text.get(b"warc-refers-to")}, end + 4


def _member(data: bytes, at: int) -> tuple[bytes, int]:
    """The whole gzip member at ``at``, checked by its CRC, and the offset behind it."""
    d, view, pos, out = zlib.decompressobj(31), memoryview(data), at, []
    while not d.eof:
        piece = view[pos:pos + (1 << 15)]
        if not piece:
            raise ValueError("cut member")
        try:
            out.append(d.decompress(piece))
        except zlib.error:
            raise ValueError("member check") from None
        pos += len(piece)
    return b"".join(out), pos - len(d.unused_data)


def _records_at(data: bytes, at: int, plain: bool) -> tuple[list[tuple[dict | None, str | None]], int]:
    """What starts at ``at``, as (record, None) or (None, reason), and the offset behind it; at least one is a record."""
    if plain or data[at:at + 3] != _MEMBER:
        record, end = parse_record(data, at)
        return [(record, None)], end
    raw, end = _member(data, at)
    try:
        record, used = parse_record(raw, 0)
        if used == len(raw):
            return [(record, None)], end
        reason = "member length"
    except ValueError as failed:
        reason = str(failed)
    found = [(record, None if record else f"{why}: inflated bytes {a} to {a + n} of the member")
             for a, n, record, why in salvage(raw, plain=True)]
    if not any(record for record, _ in found):
        raise ValueError(reason)
    return found, end


def salvage(data: bytes, plain: bool = False):
    """Yield (offset, length, record or None, reason): records, and quarantined gaps between them.
    ``plain`` data has no gzip members."""
    at, size, start = 0, len(data), _VERSION if plain else _START
    while at < size:
        if data[at] in b"\x00\r\n":  # padding between records
            at += 1
            continue
        try:
            found, end = _records_at(data, at, plain)
            for record, why in found:
                yield at, end - at, record, why
            at = end
            continue
        except ValueError as failed:
            reason = str(failed)
        resume = size
        for m in start.finditer(data, at + 1):
            try:
                _records_at(data, m.start(), plain)
                resume = m.start()
                break
            except ValueError:
                continue
        yield at, resume - at, None, reason
        at = resume


def write_archives(pages: DataFrame, path: str, compress: bool = True, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", class_bytes: int = CLASS_BYTES) -> None:
    """Write one record per row of ``pages`` below ``path``; ``class_bytes`` bounds the first class of payloads."""
    p = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"),
                     F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("_body"))
    p = p.withColumn("_key", F.sha2("_body", 256))
    # Stored, so that either side of the join has an exchange of its own and a hot payload can be split.
    # The same pass measures the longest payload.
    longest = Observation()
    shared = checkpoint(p.observe(longest, F.max(F.octet_length("_body")).alias("n")).filter(F.octet_length("_body") >= MIN_REVISIT)
                        .groupBy("_key").agg(F.max("_id").alias("_to"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n"))
    rows = p.join(shared, "_key", "left").select(
        "_id", "_url", "_body", F.sha1("_body").alias("_sha1"),
        F.when(~F.col("_id").eqNullSafe(F.col("_to")), F.col("_to")).alias("_to"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            ids, urls, bodies, digests, tos = (c for c in b.columns)
            out = [build_record(i.as_py(), u.as_py(), p.as_py(), d.as_py(), t.as_py(), t.is_valid, compress)
                   for i, u, p, d, t in zip(ids, urls, bodies, digests, tos)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    size = F.octet_length("_body")
    # Spark drops the measurement with the rest of the plan if no payload is long enough to be shared.
    n = p.agg(F.max(size)).first()[0] if shared.isEmpty() else longest.get["n"]
    bounds = size_classes(n or 0, class_bytes)
    for k, (low, high, records) in enumerate(bounds):
        part = rows if len(bounds) == 1 else rows.filter((size > low) & (size <= high))
        # Plain records end in the blank lines that the writer puts between rows; NUL padding may follow a gzip member.
        part.mapInArrow(run, "record binary").select(F.col("record").cast("string")).write.mode("append" if k else "overwrite") \
            .option("lineSep", "\x00" if compress else "\r\n\r\n").option("maxRecordsPerFile", records).text(path)


def size_classes(longest: int, first: int = CLASS_BYTES) -> list[tuple[int, int, int]]:
    """(above, up to, records an archive) for payloads of up to ``longest`` bytes: archives hold at most
    2000 times the first class's bound, or one record."""
    out, low, high, records = [], -1, first, RECORDS_PER_FILE
    while low < longest or not out:
        out.append((low, high, max(1, records)))
        low, high, records = high, high * CLASS_STEP, records // CLASS_STEP
    return out


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records (``kind`` record) and quarantined byte gaps (``kind`` gap) of all archives below ``path``."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        import pyarrow as pa

        names = ["record_type", "record_id", "target", "payload_bytes", "payload_digest", "refers_to"]
        types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
        for b in batches:
            for name, content in zip(b.column(0), b.column(1)):
                found = list(salvage(content.as_py()))
                cols = [pa.array([name.as_py()] * len(found), pa.string()), pa.array([x[0] for x in found], pa.int64()),
                        pa.array([x[1] for x in found], pa.int64()),
                        pa.array(["record" if x[2] else "gap" for x in found], pa.string()),
                        pa.array([x[3] for x in found], pa.string())]
                cols += [pa.array([x[2] and x[2][n] for x in found], t) for n, t in zip(names, types)]
                yield pa.RecordBatch.from_arrays(cols, names=["archive", "offset", "length", "kind", "reason", *names])

    return files.mapInArrow(run, READ_SCHEMA)
