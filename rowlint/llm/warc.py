"""WARC archives: write one gzip member per record, read them back in order.

Equal payloads are found by SHA-1 first: the smallest id of each digest is the
``response``, the others become ``revisit`` records without payload.  The
smallest id is a salted two-step minimum, so a payload that a third of all
pages share is never gathered in one task.

Each task writes its records to archive files of bounded size in a folder that
all executors share, under a name of its own attempt; only the files that a
finished task reports count, so a lost executor leaves no half archive in the
result.  The reader goes through an archive sequentially: incremental zlib
decompression, one member per record, content-length framing and a check of
the payload digest.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import col, shared_dir, written

SALTS = 256
MIN_REVISIT_BYTES = 0
ARCHIVE_BYTES = 32 << 20
CHUNK = 1 << 16
MANIFEST = "path string, n_records long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


class WarcError(ValueError):
    """A record that breaks the format or does not match its digest."""


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def encode_record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record as one gzip member; a revisit carries no payload."""
    revisit = refers_to is not None
    body = b"" if revisit else payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Bytes: {len(payload)}",
        "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:  # percent-coded: a line break in a url must not end the header
        head.append("WARC-Target-URI: " + "".join(c if " " < c < "\x7f" and c != "%" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url))
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + z.flush()


class Members:
    """Bytes of successive gzip members, inflated a chunk at a time."""

    def __init__(self, stream):
        self.stream, self.z, self.buf, self.left = stream, None, bytearray(), b""

    def next_member(self) -> bool:
        """Step to the next member; false at the end of the archive."""
        if not self.left:
            self.left = self.stream.read(CHUNK)
        if not self.left:
            return False
        self.z, self.buf = zlib.decompressobj(31), bytearray()
        return True

    def fill(self) -> bool:
        """Inflate one more chunk of this member; false at its end."""
        if self.z.eof:
            return False
        if not self.left:
            self.left = self.stream.read(CHUNK)
            if not self.left:
                raise WarcError("archive ends inside a record")
        data, self.left = self.left, b""
        self.buf += self.z.decompress(data, CHUNK * 4)
        self.left = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        at = 0
        while (i := self.buf.find(mark, at)) < 0:
            at = max(0, len(self.buf) - len(mark))
            if not self.fill():
                raise WarcError("record header does not end")
        out = bytes(self.buf[:i])
        del self.buf[: i + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buf) < n:
            if not self.fill():
                raise WarcError("record is shorter than its Content-Length")
        out = bytes(self.buf[:n])
        del self.buf[:n]
        return out


def _url(s: str | None) -> str | None:
    from urllib.parse import unquote_to_bytes

    return None if s is None else unquote_to_bytes(s).decode("utf-8", "surrogatepass")


def read_records(stream) -> Iterator[dict]:
    """The records of one archive, in order, each verified."""
    m = Members(stream)
    while m.next_member():
        lines = m.until(b"\r\n\r\n").decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise WarcError("not a WARC record")
        h = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        body = m.take(int(h["content-length"]))
        if m.take(4) != b"\r\n\r\n":
            raise WarcError("record does not end after its content")
        while m.fill():
            pass
        if m.buf:
            raise WarcError("bytes after the record in its member")
        digest, revisit = h["warc-payload-digest"].removeprefix("sha1:"), h["warc-type"] == "revisit"
        if not revisit and sha1_base32(body) != digest:
            raise WarcError(f"payload digest of page {h.get('x-page-id')} does not match")
        yield {
            "page_id": int(h["x-page-id"]) if "x-page-id" in h else None, "url": _url(h.get("warc-target-uri")),
            "record_type": h["warc-type"], "refers_to": int(h["warc-refers-to"][len("<urn:page:"):-1]) if revisit else None,
            "payload_digest": digest, "payload_bytes": int(h["x-payload-bytes"]) if revisit else len(body),
            "payload": None if revisit else body,
        }


def _fs(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _writer(folder: str, archive_bytes: int):
    def write(batches):
        fs, top = _fs(folder)
        fs.create_dir(top, recursive=True)
        out, done, n, size = None, [], 0, 0
        for pdf in batches:
            for page_id, url, html, sha1, first in zip(pdf["id"], pdf["url"], pdf["html"], pdf["hex"], pdf["first"], strict=True):
                if out is None:
                    path, n, size = f"{top}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(path)
                page_id, first = (None if x is None or x != x else int(x) for x in (page_id, first))
                refers = None if first is None or first == page_id else first
                member = encode_record(page_id, url, html.encode(), base64.b32encode(sha1).decode(), refers)
                out.write(member)
                n, size = n + 1, size + len(member)
                if size >= archive_bytes:
                    out.close()
                    done.append((path, n))
                    out = None
        if out is not None:
            out.close()
            done.append((path, n))
        yield pd.DataFrame(done, columns=["path", "n_records"]).astype({"path": "object", "n_records": "int64"})

    return write


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_revisit_bytes: int = MIN_REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES, salts: int = SALTS) -> DataFrame:
    """Write every page as a WARC record below ``folder``; returns the manifest.

    Of records with equal payloads of ``min_revisit_bytes`` or more, the one
    with the smallest id is the response and the others revisit it.  Null
    payloads count as empty.  A null id revisits the smallest id with its
    payload, and is a response if there is none; rows that repeat the smallest
    id are all responses.  An empty table gives no archive.  Other columns are
    not read, so their names do not matter.

    ``folder`` must be one that all executors share.
    """
    html = F.coalesce(col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(col(id_col).cast("long").alias("id"), col(url_col).cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumns({"hex": F.unhex(F.sha1("html")), "salt": F.pmod(F.xxhash64("id", "url"), F.lit(salts)).cast("int"),
                             "big": F.octet_length("html") >= min_revisit_bytes})
    # smallest id of a digest: per salt with map-side combine, then over its few salts
    part = rows.where("big").groupBy("hex", "salt").agg(F.min("id").alias("lo"))
    first = part.select("hex", "salt", F.min("lo").over(Window.partitionBy("hex")).alias("first"))
    dealt = rows.join(first, ["hex", "salt"], "left").select(
        "id", "url", "html", "hex", F.when(F.col("big"), F.col("first")).alias("first"))
    return written(dealt.mapInPandas(_writer(folder, archive_bytes), MANIFEST), "manifest")


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the archives that ``manifest`` lists (``path, n_records``).

    One task reads an archive from start to end and fails on a record that is
    cut short, framed wrongly, or differs from its digest, and on an archive
    that holds another number of records than the manifest says.
    ``payloads=False`` leaves the payload column null (it is still verified).
    """
    def read(batches):
        for pdf in batches:
            for path, want in zip(pdf["path"], pdf["n_records"], strict=True):
                fs, at = _fs(path)
                got, rows, size = 0, [], 0
                with fs.open_input_stream(at) as stream:
                    for r in read_records(stream):
                        got += 1
                        if not payloads:
                            r["payload"] = None
                        rows.append(r)
                        size += len(r["payload"] or b"") + 200
                        if size > 8 << 20:
                            yield _frame(rows)
                            rows, size = [], 0
                if got != want:
                    raise WarcError(f"{path}: {got} records, the manifest says {want}")
                if rows:
                    yield _frame(rows)

    # one small row per archive: dealt evenly, whatever files the manifest is in
    spread = manifest.repartition(manifest.sparkSession.sparkContext.defaultParallelism)
    return spread.mapInPandas(read, RECORD)


def _frame(rows: list[dict]) -> pd.DataFrame:
    df = pd.DataFrame(rows, columns=["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"])
    return df.astype({"page_id": "Int64", "refers_to": "Int64"})


def op8_warc(spark, sf_dir):
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return read_archives(write_archives(pages, folder), payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# base32 in DuckDB: five bits at a time out of the 160 of the digest
OP8_SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(instr('0123456789abcdef', substr(hex, i, 1)) - 1), 4, '0')), '') AS bits FROM p),
d AS (SELECT page_id, strlen(html) AS payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  CAST(list_sum(list_transform(range(5), lambda j: CAST(substr(bits, i * 5 + j + 1, 1) AS INT) * (16 >> j))) AS BIGINT) + 1, 1)), '') AS payload_digest FROM b),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS lo FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = lo THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = lo THEN NULL ELSE lo END AS refers_to FROM f"""
