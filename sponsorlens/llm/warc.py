"""WARC archives: writer with revisits, and a reader that salvages damaged ones.

``write`` stores one record per row as a gzip member of its own (or plain), in
files of bounded size in the shared folder. Of rows with equal payloads of at
least ``revisit_bytes`` bytes, those with the largest id are responses and the
others revisit it, without a body. The files are named by a manifest table that
Spark writes, so a repeated task leaves an unlisted file, never a double record.

``read`` streams each archive. A record counts if its member inflates with a
right checksum (compressed), its version line, headers and Content-Length are
whole, its end marker stands where it should and its digests fit. After a failed
check the reader looks for the next member that inflates to a version line (or
the next version line, if plain) and goes on there; what lies between is
reported as a quarantined gap (file, offset, length, reason).

Null payloads are empty. A null id is never the one that others refer to, and
is response only where its payload has no row with an id. Rows that repeat the
largest id are all responses. Extra columns aren't archived.
"""
from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sponsorlens.session import new_dir

from .common import table, written

VERSION = b"WARC/1.1\r\n"
GZIP = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
FILE_BYTES = 64 << 20
BLOCK = 1 << 20
HEADER_LIMIT = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = ("file string, offset long, length long, gap string, record_type string, record_id string, refers_to string, "
          "uri string, payload_digest string, payload_bytes long, payload binary")


def sha1_32(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if re.match(r"\w+:", path) else f"file://{path}")


def record(kind: str, record_id: str, payload: bytes, uri: str, refers_to: str | None) -> bytes:
    """One record; a revisit tells its payload's length and digest and has no body."""
    body = b"" if kind == "revisit" else payload
    digest = "sha1:" + sha1_32(payload)
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Payload-Digest: {digest}", f"WARC-Payload-Length: {len(payload)}",
            f"WARC-Block-Digest: {digest if body is payload else 'sha1:' + sha1_32(body)}",
            "Content-Type: text/html", f"Content-Length: {len(body)}"]
    if uri:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", uri))
    if kind == "revisit":
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return VERSION + "\r\n".join(head).encode() + END + body + END


def member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write(pages: DataFrame, page_id: str = "page_id", payload: str = "html", uri: str = "url",
          revisit_bytes: int = 0, compressed: bool = True, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Archives of ``pages``; returns the manifest (file, bytes, records)."""
    spark = pages.sparkSession
    folder = new_dir(spark, "llm", "warc")
    url = F.col(uri) if uri in pages.columns else F.lit("")
    rows = pages.select(F.col(page_id).alias("id"), F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
                        F.coalesce(url, F.lit("")).alias("uri")).withColumn("sha", F.sha1("payload"))
    # Only payloads that occur more than once are looked up; a table of its own,
    # so that the join below shuffles both sides itself and may split a hot one.
    repeated = written(rows.filter(F.length("payload") >= revisit_bytes).groupBy("sha").agg(
        F.count("*").alias("n"), F.max("id").alias("first")).filter((F.col("n") > 1) & F.col("first").isNotNull())
        .select("sha", "first"), "repeated")
    joined = rows.join(repeated, "sha", "left")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_store(folder)
        fs.create_dir(root, recursive=True)
        out, name, size, n, done = None, "", 0, 0, []
        for b in batches:
            for i, data, url, first in zip(*(b.column(c).to_pylist() for c in ("id", "payload", "uri", "first"))):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc" + ".gz" * compressed
                    # Members are compressed already; by its name the file would be compressed as a whole once more.
                    out, size, n = fs.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                again = first is not None and i != first
                r = record("revisit" if again else "response", f"urn:page:{'' if i is None else i}", data, url,
                           f"urn:page:{first}" if again else None)
                r = member(r) if compressed else r
                out.write(r)
                size, n = size + len(r), n + 1
                if size >= file_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", size, n))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", size, n))
        yield pa.RecordBatch.from_pydict(
            {"file": [x for x, _, _ in done], "bytes": [x for _, x, _ in done], "records": [x for _, _, x in done]},
            schema=pa.schema([("file", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))

    return written(joined.select("id", "payload", "uri", "first").mapInArrow(
        archive, "file string, bytes long, records long"), "manifest")


class Window:
    """A sliding view of a stream: bytes from ``base`` on."""

    def __init__(self, stream):
        self.stream, self.base, self.data, self.ended = stream, 0, bytearray(), False
        self.size = stream.seek(0, 2)
        stream.seek(0)

    def more(self) -> bool:
        b = b"" if self.ended else self.stream.read(BLOCK)
        self.ended = not b
        self.data += b
        return bool(b)

    def get(self, at: int, n: int) -> bytes:
        """Up to n bytes at an offset that isn't before the base."""
        while len(self.data) < at - self.base + n and self.more():
            pass
        return bytes(self.data[at - self.base : at - self.base + n])

    def ahead(self, at: int, n: int) -> bytes:
        """n bytes at an offset, or none past the end; what lies before them isn't read."""
        held = self.base + len(self.data)
        if at + n <= held:
            return self.get(at, n)
        if at + n > self.size:
            return b""
        self.stream.seek(at)
        got = self.stream.read(n)
        self.stream.seek(held)
        return got

    def find(self, mark: bytes, at: int) -> int:
        """Where the mark stands next, or -1; bytes before it may be let go."""
        while True:
            k = self.data.find(mark, at - self.base)
            if k >= 0:
                return self.base + k
            at = max(at, self.base + len(self.data) - len(mark) + 1)
            if not self.more():
                return -1
            self.drop(min(at, self.base + len(self.data)))

    def drop(self, at: int) -> None:
        if at - self.base >= BLOCK:
            del self.data[: at - self.base]
            self.base = at


class Bad(Exception):
    pass


def headers(block: bytes) -> dict[str, str]:
    if not re.match(rb"WARC/1\.[01]\r\n", block):
        raise Bad("no version line")
    out: dict[str, str] = {}
    for line in block.split(b"\r\n")[1:]:
        k, colon, v = line.partition(b":")
        if not colon or not k.strip():
            raise Bad("broken header line")
        out[k.strip().lower().decode("utf-8", "replace")] = v.strip().decode("utf-8", "replace")
    if not re.fullmatch("[0-9]{1,18}", out.get("content-length", "")) or "warc-type" not in out:
        raise Bad("no length or type")
    return out


def check(head: dict[str, str], body: bytes) -> None:
    if len(body) != int(head["content-length"]):
        raise Bad("truncated block")
    for key in ("warc-block-digest", *(["warc-payload-digest"] if head["warc-type"] != "revisit" and "http" not in head.get("content-type", "") else [])):
        said = head.get(key, "")
        if said.lower().startswith("sha1:") and said[5:].upper() != sha1_32(body):
            raise Bad(f"wrong {key[5:]}")


def plain_record(w: Window, at: int) -> tuple[dict, bytes, int]:
    """Headers, block and end of the record at an offset."""
    n = 4096
    while (k := (head := w.get(at, n)).find(END)) < 0:
        if len(head) < n or n > HEADER_LIMIT:
            raise Bad("headers without end")
        n *= 4
    got = headers(head[:k])
    body, size = at + k + 4, int(got["content-length"])
    # The mark first: a damaged length must not bring the rest of the file into memory.
    if w.ahead(body + size, 4) != END:
        raise Bad("no end marker where the block ends")
    block = w.get(body, size)
    check(got, block)
    return got, block, body + size + 4


def gzip_record(w: Window, at: int) -> tuple[dict, bytes, int]:
    z, parts, p = zlib.decompressobj(31), [], at
    try:
        while not z.eof:
            b = w.get(p, 1 << 16)
            if not b:
                raise Bad("truncated member")
            parts.append(z.decompress(b))
            if p == at and parts[0] and not parts[0].startswith(b"WARC/1."[: len(parts[0])]):
                raise Bad("no version line")
            p += len(b)
    except zlib.error as e:
        raise Bad("broken member: " + re.sub(r"^.*: ", "", str(e))) from None
    end = p - len(z.unused_data)
    data = b"".join(parts)
    k = data.find(END)
    if k < 0:
        raise Bad("headers without end")
    got = headers(data[:k])
    body, tail = data[k + 4 : -4], data[-4:]
    if tail != END:
        raise Bad("no end marker where the block ends")
    check(got, body)
    return got, body, end


def is_gzip(stream) -> bool:
    """Whether members stand in the stream: by its first bytes or, if they are
    damaged, by the first block that holds a mark."""
    stream.seek(0)
    tail, got = b"", False
    while block := stream.read(BLOCK):
        block = tail + block
        if GZIP in block or b"WARC/1." in block:
            got = block.startswith(GZIP) and not tail or b"WARC/1." not in block
            break
        tail = block[-6:]
    stream.seek(0)
    return got


def salvage(stream) -> Iterator[tuple]:
    """(offset, length, None, headers, block) of records and (offset, length, reason, None, None) of gaps."""
    gzipped = is_gzip(stream)
    w, at = Window(stream), 0
    mark, one = (GZIP, gzip_record) if gzipped else (b"WARC/1.", plain_record)
    gap, why = None, ""
    while w.get(at, 1):
        try:
            if w.get(at, len(mark)) != mark:
                raise Bad("no record start")
            head, block, end = one(w, at)
        except Bad as e:
            if gap is None:
                gap, why = at, str(e)
            nxt = w.find(mark, at + 1)
            if nxt < 0:
                at = w.base + len(w.data)
                break
            at = nxt
            continue
        if gap is not None:
            yield gap, at - gap, why, None, None
            gap = None
        yield at, end - at, None, head, block
        at = end
        w.drop(at)
    if gap is not None:
        yield gap, at - gap, why, None, None


def read(files: DataFrame, file: str = "file") -> DataFrame:
    """Records and gaps (rows with a reason in ``gap``) of the archives named in ``files``."""
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bare = lambda x: x[1:-1] if x[:1] == "<" else x
        schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("gap", pa.string()),
                            ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()), ("uri", pa.string()),
                            ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
        for b in batches:
            for path in b.column(0).to_pylist():
                fs, name = open_store(path)
                rows, held = [], 0
                # Not as a stream: that would inflate the file by its name, and a damaged member would end it.
                with fs.open_input_file(name) as stream:
                    for at, n, why, h, block in salvage(stream):
                        if h is None:
                            rows.append((path, at, n, why, *[None] * 7))
                        else:
                            digest = h.get("warc-payload-digest", "")
                            size = h.get("warc-payload-length", "")
                            rows.append((path, at, n, None, h["warc-type"], bare(h.get("warc-record-id", "")),
                                         bare(h["warc-refers-to"]) if "warc-refers-to" in h else None, h.get("warc-target-uri"),
                                         digest[5:] if digest.lower().startswith("sha1:") else sha1_32(block),
                                         int(size) if size.isdigit() else len(block), None if h["warc-type"] == "revisit" else block))
                            held += len(block)
                        if held > 8 << 20 or len(rows) > 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return files.select(F.col(file)).repartition(parts, F.col(file)).mapInArrow(run, RECORD)


def op1_warc(spark, sf_dir: str) -> DataFrame:
    archived = read(write(table(spark, sf_dir, "pages")))
    number = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1).try_cast("long")
    return archived.filter("gap is null").select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))


#: Base 32 of a SHA-1 in hexadecimal: 32 groups of five bits, each inside two neighbouring digits.
OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT h, max(page_id) AS top FROM p GROUP BY h)
SELECT p.page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((
    16 * (strpos('0123456789abcdef', substr(p.h, (5 * i) // 4 + 1, 1)) - 1)
    + strpos('0123456789abcdef', substr(p.h, (5 * i) // 4 + 2, 1)) - 1) >> (3 - (5 * i) % 4)) & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = top OR top IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NOT DISTINCT FROM top THEN NULL ELSE top END AS refers_to
FROM p JOIN g USING (h)
"""
