"""Fill-in-middle transformation by displacement scatter.

A text of n code points is cut at two seeded places into prefix, middle and
suffix, and written as ``<P>prefix<S>suffix<M>middle`` (psm) or
``<S>suffix<P>prefix<M>middle`` (spm); some texts stay plain.

The texts of an Arrow batch are one buffer of bytes with offsets.  A scan finds
the byte of each cut; every piece of every row then has one displacement, the
distance its bytes travel to the output.  Written as differences at the
pieces' first bytes, their cumulative sum gives every byte its shift, and one
numpy scatter builds all outputs of the batch.  Restoring scans the output for
the markers, derives the inverse shifts the same way, and gathers.

All byte-sized arrays are made for ``BLOCK`` bytes at a time and batches are cut
into slices of about ``SLICE`` bytes, so memory is bounded by the longest single
text (its bytes in and out) plus a constant.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import col

MARKERS = ("<P>", "<S>", "<M>")
RATE, SPM_RATE, SEED = 90, 20, 1  # per cent
SLICE = 8 << 20
BLOCK = 1 << 20
PLAIN, PSM, SPM = 0, 1, 2
FORMS = np.array(["plain", "psm", "spm"])
FIM = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def check_markers(markers) -> tuple[bytes, bytes, bytes]:
    """Markers that no join of text and marker can imitate: a first character
    of a marker occurs nowhere else in the markers, and none begins another."""
    marks = tuple(m.encode() for m in markers)
    heads = {m[:1] for m in marks}
    if len(marks) != 3 or not all(marks) or any(a != b and b.startswith(a) for a in marks for b in marks) or len(set(marks)) < 3:
        raise ValueError("three different markers, none of which begins another")
    if any(m[i:i + 1] in heads for m in marks for i in range(1, len(m))) or any(h >= b"\x80" for h in heads):
        raise ValueError("a marker's first character must be ASCII and occur in no marker again")
    return marks


def draws(ids: list, seed: int) -> np.ndarray:
    """(rows, 4): the first four 8-digit groups of the hex sha256 of ``seed:id``; a null id draws as an empty one."""
    out = np.empty((len(ids), 4), np.int64)
    for i, x in enumerate(ids):
        out[i] = np.frombuffer(hashlib.sha256(f"{seed}:{'' if x is None else x}".encode()).digest()[:16], ">u4")
    return out


def _texts(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the rows' offsets in them; a null is empty."""
    arr = arr.fill_null("").cast(pa.large_string())
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def _select(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, "callable"]:
    """Code points before each offset, and a function from code point numbers to bytes."""
    blocks = range(0, len(data), BLOCK)
    per_block = np.array([np.count_nonzero((data[b:b + BLOCK] & 0xC0) != 0x80) for b in blocks], np.int64)
    before = np.r_[0, np.cumsum(per_block)]

    def rank(places: np.ndarray) -> np.ndarray:
        out = np.empty(len(places), np.int64)
        for k, b in enumerate(blocks):
            mine = np.flatnonzero((places >= b) & (places < b + BLOCK))
            if len(mine):
                lead = np.cumsum((data[b:b + BLOCK] & 0xC0) != 0x80)
                at = places[mine] - b
                out[mine] = before[k] + np.where(at > 0, lead[at - 1], 0)
        out[places >= len(data)] = before[-1]
        return out

    def place(points: np.ndarray) -> np.ndarray:
        out = np.full(len(points), len(data), np.int64)
        for k, b in enumerate(blocks):
            mine = np.flatnonzero((points >= before[k]) & (points < before[k + 1]))
            if len(mine):
                out[mine] = b + np.flatnonzero((data[b:b + BLOCK] & 0xC0) != 0x80)[points[mine] - before[k]]
        return out

    return rank(off), place


def _shifts(starts: np.ndarray, shift: np.ndarray, size: int):
    """Blocks of (first byte, every byte's shift) from the pieces' first bytes and shifts.

    The pieces cover all bytes in order; of pieces that begin at one byte the
    last holds it.  Each block is the cumulative sum of its difference array.
    """
    diff = np.diff(shift, prepend=0)
    for b in range(0, size, BLOCK):
        e = min(b + BLOCK, size)
        lo, hi = np.searchsorted(starts, [b, e])
        step = np.zeros(e - b, np.int64)
        np.add.at(step, starts[lo:hi] - b, diff[lo:hi])
        step[0] += shift[lo - 1] if lo else 0
        yield b, np.cumsum(step, out=step)


def _scatter(data: np.ndarray, starts: np.ndarray, shift: np.ndarray, out: np.ndarray) -> None:
    for b, s in _shifts(starts, shift, len(data)):
        out[np.arange(b, b + len(s)) + s] = data[b:b + len(s)]


def _gather(data: np.ndarray, starts: np.ndarray, shift: np.ndarray, size: int) -> np.ndarray:
    back = np.empty(size, np.uint8)
    for b, s in _shifts(starts, shift, size):
        back[b:b + len(s)] = data[np.arange(b, b + len(s)) + s]
    return back


def _hits(data: np.ndarray, off: np.ndarray, marks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, marker) of every marker that lies inside one row."""
    found = [(m.start(), m.end(), marks.index(m[0])) for m in re.finditer(b"|".join(re.escape(m) for m in marks), memoryview(data))]
    if not found:
        return (np.empty(0, np.int64),) * 3
    at, end, which = np.array(found, np.int64).T
    row = np.searchsorted(off, at, side="right") - 1
    inside = end <= off[row + 1]
    return row[inside], at[inside], which[inside]


def transform(data: np.ndarray, off: np.ndarray, h: np.ndarray, marks, rate: int, spm_rate: int):
    """Output bytes and offsets of every row, with n, form and the two cuts in code points."""
    rows = len(off) - 1
    before, place = _select(data, off)
    n = np.diff(before)
    a, b = np.sort(h[:, :2] % (n + 1)[:, None], axis=1).T
    form = np.where(h[:, 3] % 100 < spm_rate, SPM, PSM)
    form[(n == 0) | (h[:, 2] % 100 >= rate)] = PLAIN
    form[_hits(data, off, marks)[0]] = PLAIN
    cut = form != PLAIN
    start, end = off[:-1], off[1:]
    x, y = start.copy(), start.copy()  # a plain text is all middle
    x[cut], y[cut] = place(before[:-1][cut] + a[cut]), place(before[:-1][cut] + b[cut])
    x, y = np.minimum(x, end), np.minimum(y, end)
    y[~cut] = start[~cut]
    size = end - start + cut * sum(map(len, marks))
    to = np.r_[0, np.cumsum(size)]
    p, s, m = map(len, marks)
    psm, spm = form == PSM, form == SPM
    at_p = to[:-1] + spm * (s + end - y)
    at_s = to[:-1] + psm * (p + x - start)
    at_m = np.where(psm, at_s + s + end - y, at_p + p + x - start)
    # pieces in text order: prefix, middle, suffix; a plain text is one piece, named three times
    home = to[:-1] - start
    shift = np.stack([np.where(cut, at_p + p - start, home), np.where(cut, at_m + m - x, home), np.where(cut, at_s + s - y, home)], 1)
    starts = np.stack([start, np.where(cut, x, start), np.where(cut, y, start)], 1)
    out = np.empty(to[-1], np.uint8)
    _scatter(data, starts.ravel(), shift.ravel(), out)
    for at, mark in ((at_p, marks[0]), (at_s, marks[1]), (at_m, marks[2])):
        out[(at[cut, None] + np.arange(len(mark))).ravel()] = np.tile(np.frombuffer(mark, np.uint8), int(cut.sum()))
    return out, to, n, form, a, b


def inverse(data: np.ndarray, off: np.ndarray, form: np.ndarray, marks):
    """Texts and offsets back from outputs and forms; a psm or spm row without
    its three markers is not an output and is returned as it is."""
    row, at, which = _hits(data, off, marks)
    pos = np.full((len(off) - 1, 3), -1, np.int64)
    pos[row, which] = at
    cut = (form != PLAIN) & (pos >= 0).all(1)
    p, s, m = map(len, marks)
    start, end, psm = off[:-1], off[1:], form == PSM
    at_p, at_s, at_m = pos.T
    # where each piece lies in the output
    pre, pre_end = at_p + p, np.where(psm, at_s, at_m)
    suf, suf_end = at_s + s, np.where(psm, at_m, at_p)
    mid = at_m + m
    size = end - start - cut * (p + s + m)
    to = np.r_[0, np.cumsum(size)]
    home = to[:-1]
    first = np.where(cut, pre_end - pre, 0)
    second = np.where(cut, first + end - mid, 0)
    starts = np.stack([home, home + first, home + second], 1)
    shift = np.stack([np.where(cut, pre - home, start - home), np.where(cut, mid - home - first, start - home),
                      np.where(cut, suf - home - second, start - home)], 1)
    return _gather(data, starts.ravel(), shift.ravel(), int(to[-1])), to


def _strings(data: np.ndarray, off: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(off) - 1, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def _slices(batch: pa.RecordBatch, text: str):
    """Parts of the batch of about ``SLICE`` bytes of text, one row at least."""
    sizes = np.asarray(pa.compute.binary_length(batch.column(text)).fill_null(0), np.int64)
    ends = np.cumsum(sizes)
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + SLICE, side="right")))
        yield batch.slice(i, j - i)
        i = j


def _fim(marks, seed, rate, spm_rate):
    def fim(batches):
        import pyarrow.compute  # noqa: F401

        for batch in batches:
            for part in _slices(batch, "text"):
                ids = part.column("doc_id")
                data, off = _texts(part.column("text"))
                out, to, n, form, a, b = transform(data, off, draws(ids.to_pylist(), seed), marks, rate, spm_rate)
                plain = form == PLAIN
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(n), pa.array(FORMS[form]), pa.array(a, mask=plain), pa.array(b - a, mask=plain), _strings(out, to),
                ], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return fim


def _restore(marks, names):
    def restore(batches):
        import pyarrow.compute  # noqa: F401

        for batch in batches:
            for part in _slices(batch, "output"):
                data, off = _texts(part.column("output"))
                form = np.array([{"psm": PSM, "spm": SPM}.get(x, PLAIN) for x in part.column("form").to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], _strings(*inverse(data, off, form, marks))], [*names, "restored"])

    return restore


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE,
                   spm_rate: int = SPM_RATE, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``: one row per row of ``docs``.

    ``rate`` per cent of the texts are cut, ``spm_rate`` per cent of those written
    suffix first.  Which, and where, follows from ``seed`` and the id alone: rows
    of one id and text get one output, and a null id draws as an empty one.  A
    null text is empty.  Empty texts and texts that hold a marker stay plain
    (with null ``prefix_chars`` and ``middle_chars``).  An empty table gives an
    empty result.  Other columns are not read.  No shuffle.
    """
    marks = check_markers(markers)
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_fim(marks, seed, rate, spm_rate), FIM)


def restore(outputs: DataFrame, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """``outputs`` (with columns ``form`` and ``output``) with ``restored``, the text
    that each was made of, from these two columns alone.  ``output`` itself is left out."""
    marks = check_markers(markers)
    names = [c for c in outputs.columns if c not in ("output", "restored")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outputs.schema if f.name in names)
    return outputs.select(*names, "output").mapInArrow(_restore(marks, names), f"{schema}, restored string")


def _sha(c: str) -> Column:
    return F.sha2(F.encode(c, "UTF-8"), 256)


def op11_fim(spark, sf_dir):
    made = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return restore(made.withColumn("output_sha256", _sha("output"))).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", _sha("restored").alias("restored_sha256"))


OP11_SQL = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
e AS (SELECT doc_id, t, length(t) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
  CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
       WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM e),
g AS (SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1, n - b) AS s FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM g"""
