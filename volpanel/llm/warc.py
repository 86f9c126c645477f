"""WARC archives: a writer of gzip members and a splittable reader.

Writer.  Equal payloads are found by (SHA-1, length) with ``group_min`` (no key's rows meet in one
task); the row with the smallest page_id is a ``response`` record, the others are ``revisit`` records
that refer to it and hold no payload.  Each task writes one archive, a gzip member per record, under
a name of its own attempt; only archives reported by finished tasks are in the manifest, so a
lost or repeated attempt leaves no record behind.

Reader.  An archive is cut into byte ranges of ``SPLIT`` bytes, each a task's row.  A task scans its range
for the gzip magic, and takes a candidate as a member if it decodes to the end with its checksum and holds one
WARC record (version line, headers, a block of Content-Length bytes, two line ends).  It owns the
records that start inside its range, reading past the range's end for the last one; after a valid member
the next candidate is the byte behind it.  A member's compressed bytes can hold the magic by chance;
such candidates fail to decode.  (Members stored without compression whose payload is itself a WARC
member would be seen by a task that starts inside them; this writer always compresses.)

Defined cases: null payload is empty; payloads below ``min_bytes`` are all responses; rows without
page_id are responses and never referred to; rows that repeat the smallest page_id of a payload are
all responses; null url is written as no target; control characters in a url are kept by an escaped copy.
An empty table gives no archive and no records.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volpanel.llm.common import group_min, shared_path, shuffle_parts, stored, worker_fs

SPLIT = 8 << 20
MAGIC = b"\x1f\x8b\x08"
CHUNK = 1 << 20
LEVEL = 5
DATE = "2024-01-01T00:00:00Z"


# ---- writing -----------------------------------------------------------------------

def header(fields: list[tuple[str, str]]) -> bytes:
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + b"\r\n"


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record; ``refers_to`` None makes a response."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE)]
    if page_id is not None:
        fields.append(("Page-ID", str(page_id)))
    if url is not None:
        plain = "".join(c if c >= " " and c != "\x7f" else "_" for c in url).strip()
        fields.append(("WARC-Target-URI", plain))
        if plain != url:
            fields.append(("Target-JSON", json.dumps(url)))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if refers_to is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("Refers-To-Page-ID", str(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return header(fields) + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Manifest (file, bytes, records) of the archives written to the shared folder."""
    spark = pages.sparkSession
    folder = shared_path(spark, "warc")
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(F.encode(html, "utf-8")).alias("sha"), F.octet_length(html).alias("n"))
    rows = group_min(rows, ["sha", "n"], "page_id", "first")
    refers = F.when((F.col("n") >= min_bytes) & (F.col("page_id") != F.col("first")), F.col("first"))
    rows = rows.select("page_id", "url", "html", "sha", refers.alias("refers"))

    def run(batches):
        out, name, n, size = None, None, 0, 0
        for b in batches:
            for page_id, url, text, sha, ref in zip(*(b.column(k).to_pylist() for k in range(5))):
                if out is None:
                    files, where = worker_fs(folder)
                    files.create_dir(where, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = files.open_output_stream(f"{where}/{name}", compression=None)
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                data = member(record(page_id, url, text.encode(), digest, ref))
                out.write(data)
                n, size = n + 1, size + len(data)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "bytes": pa.array([size], pa.int64()), "records": pa.array([n], pa.int64())})

    return stored(rows.mapInArrow(run, "file string, bytes long, records long"), "manifest")


# ---- reading -----------------------------------------------------------------------

class Window:
    """Bytes of a file from ``start`` on, read in chunks as they are needed."""

    def __init__(self, f, start: int, size: int):
        self.f, self.base, self.size, self.data = f, start, size, bytearray()

    def more(self) -> bool:
        at = self.base + len(self.data)
        if at >= self.size:
            return False
        self.f.seek(at)
        got = self.f.read(min(CHUNK, self.size - at))
        self.data += got
        return bool(got)

    def drop(self, upto: int):
        """Forget the bytes before position ``upto`` of the file."""
        n = min(max(0, upto - self.base), len(self.data))
        del self.data[:n]
        self.base += n


def next_magic(w: Window, at: int, end: int) -> int | None:
    """The first position of the magic in [at, end)."""
    while at < end:
        i = w.data.find(MAGIC, at - w.base)
        if i >= 0:
            return w.base + i if w.base + i < end else None
        at = max(at, w.base + len(w.data) - len(MAGIC) + 1)
        w.drop(at)
        if not w.more():
            return None
    return None


def decode_member(w: Window, at: int) -> tuple[bytes, int] | None:
    """(content, position behind the member), or None if no WARC member starts at ``at``."""
    z, out, pos = zlib.decompressobj(31), bytearray(), at
    try:
        while not z.eof:
            if pos - w.base >= len(w.data) and not w.more():
                return None
            piece = bytes(w.data[pos - w.base : pos - w.base + CHUNK])
            out += z.decompress(piece)
            pos += len(piece) - len(z.unused_data)
            if len(out) >= 5 and not out.startswith(b"WARC/"):
                return None
    except zlib.error:
        return None
    return (bytes(out), pos) if out.startswith(b"WARC/") else None


def parse_record(data: bytes) -> dict | None:
    """Fields, block and payload of one record, or None if it is not well-formed."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    try:
        fields = {}
        for line in lines[1:]:
            k, colon, v = line.partition(b":")
            if not colon:
                return None
            fields[k.decode().strip().lower()] = v.decode().strip()
        n = int(fields["content-length"])
    except (KeyError, ValueError):
        return None
    if not sep or len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        return None
    http, sep, payload = rest[:n].partition(b"\r\n\r\n")
    length = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), len(payload))
    return {"fields": fields, "payload": payload, "length": length}


def records_of(f, start: int, end: int, size: int):
    """Records that start in [start, end) of an open file of ``size`` bytes."""
    w, at = Window(f, start, size), start
    while at < end:
        at = next_magic(w, at, end)
        if at is None:
            return
        got = decode_member(w, at)
        rec = parse_record(got[0]) if got else None
        if rec is None:
            at += 1
        else:
            yield rec
            at = got[1]
        w.drop(at)


COLUMNS = "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"


def read(manifest: DataFrame, split: int = SPLIT) -> DataFrame:
    """All records of the archives; revisits have no payload but its length and digest."""
    def run(batches):
        for b in batches:
            for file, start, size in zip(*(b.column(k).to_pylist() for k in range(3))):
                files, where = worker_fs(file)
                out: dict[str, list] = {c.split()[0]: [] for c in COLUMNS.split(", ")}

                def batch():
                    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
                    return pa.RecordBatch.from_arrays([pa.array(out[c.split()[0]], kinds[c.split()[1]]) for c in COLUMNS.split(", ")], names=list(out))

                with files.open_input_file(where) as f:
                    held = 0
                    for rec in records_of(f, start, min(start + split, size), size):
                        h, whole = rec["fields"], rec["fields"]["warc-type"] == "response"
                        digest = h["warc-payload-digest"].removeprefix("sha1:")
                        if whole and base64.b32encode(hashlib.sha1(rec["payload"]).digest()).decode() != digest:
                            raise ValueError(f"{file}: payload does not match its digest")
                        url = json.loads(h["target-json"]) if "target-json" in h else h.get("warc-target-uri")
                        row = (int(h["page-id"]) if "page-id" in h else None, url, h["warc-type"], rec["payload"] if whole else None, rec["length"], digest, int(h["refers-to-page-id"]) if "refers-to-page-id" in h else None)
                        for c, v in zip(out, row):
                            out[c].append(v)
                        held += len(rec["payload"])
                        if held > 4 * CHUNK:
                            yield batch()
                            held, out = 0, {c: [] for c in out}
                yield batch()

    ranges = manifest.select("file", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split).cast("long"))).alias("start"), "bytes")
    return ranges.repartition(shuffle_parts(manifest.sparkSession)).mapInArrow(run, COLUMNS)
