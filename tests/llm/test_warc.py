import base64
import gzip
import hashlib
import io

import pytest

from rowlint.llm._common import shared_dir
from rowlint.llm.warc import WarcError, encode_record, read_archives, read_records, sha1_base32, write_archives


def run(spark, rows, name, **kw):
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    manifest = write_archives(df, f"{shared_dir(spark)}/{name}", **kw)
    return manifest, sorted(read_archives(manifest).collect(), key=str)


def test_round_trip_and_revisits(spark):
    rows = [(5, "u5", "same"), (3, "u3", "same"), (9, "u\r\nX: é%", "same"), (1, None, None), (2, "u2", ""), (4, "é", "é" * 5000), (None, "n", "same"),
            (3, "again", "same"), (None, None, "alone")]
    _, got = run(spark, rows, "warc-a")
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = []
    for i, u, h in rows:
        data = (h or "").encode()
        lo = first.get(h or "")
        revisit = lo is not None and lo != i
        want.append((i, u, "revisit" if revisit else "response", lo if revisit else None, base64.b32encode(hashlib.sha1(data).digest()).decode(),
                     len(data), None if revisit else data))
    assert [tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in got] == sorted(want, key=str) or sorted(
        (tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in got), key=str) == sorted(want, key=str)


def test_min_revisit_bytes_and_rotation(spark):
    rows = [(i, f"u{i}", "tiny" if i % 2 else "large enough payload " * 200 + str(i)) for i in range(60)]
    manifest, got = run(spark, rows, "warc-b", min_revisit_bytes=10, archive_bytes=500)
    assert all(r["record_type"] == "response" for r in got) and len(got) == 60
    assert manifest.count() > 10


def test_empty_table(spark):
    manifest, got = run(spark, [], "warc-c")
    assert got == [] and manifest.count() == 0


def test_members_are_plain_gzip():
    a = encode_record(1, "u", b"abc", sha1_base32(b"abc"), None)
    b = encode_record(2, "u", b"abc", sha1_base32(b"abc"), 1)
    assert gzip.decompress(a + b).count(b"WARC/1.1") == 2
    got = list(read_records(io.BytesIO(a + b)))
    assert [(r["page_id"], r["record_type"], r["refers_to"]) for r in got] == [(1, "response", None), (2, "revisit", 1)]


def test_large_record_reads_in_chunks():
    data = bytes(range(256)) * 20000
    rec = encode_record(1, None, data, sha1_base32(data), None)
    assert next(read_records(io.BytesIO(rec)))["payload"] == data


@pytest.mark.parametrize("spoil", [lambda a: a[:-9], lambda a: gzip.compress(gzip.decompress(a).replace(b"abc", b"abd")),
                                   lambda a: gzip.compress(gzip.decompress(a).replace(b"Content-Length: 3", b"Content-Length: 2")),
                                   lambda a: gzip.compress(b"no record\r\n\r\n")])
def test_broken_archives_are_refused(spoil):
    rec = encode_record(1, "u", b"abc", sha1_base32(b"abc"), None)
    with pytest.raises(WarcError):
        list(read_records(io.BytesIO(spoil(rec))))
