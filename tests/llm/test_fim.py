import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowlint.llm import fim


def brute(doc_id, text, seed=1, rate=90, spm_rate=20, marks=fim.MARKERS):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, s, m = marks
    if not n or any(x in text for x in marks) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text, text
    if h4 % 100 < spm_rate:
        return doc_id, n, "spm", a, b - a, s + text[b:] + p + text[:a] + m + text[a:b], text
    return doc_id, n, "psm", a, b - a, p + text[:a] + s + text[b:] + m + text[a:b], text


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, output string, n int")
    made = fim.fill_in_middle(df, **kw)
    opts = {"markers": kw["markers"]} if "markers" in kw else {}
    return sorted((tuple(r) for r in fim.restore(made.withColumn("o", F.col("output")), **opts).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "o", "restored").collect()), key=str)


def rows():
    random.seed(5)
    letters = "ab<PSM> \né€\U0001f600"
    out = [(i, "".join(random.choices(letters, k=random.randrange(40)))) for i in range(400)]
    out += [(1000, None), (1001, ""), (None, "a null id"), (None, None), (1002, "one <M> marker"), (1003, "ends <"), (1004, "P> begins"), (1005, "<"), (1006, "P>")]
    out += [out[3], out[3], (2000, "é" * 50_000 + "x" * 30_000), (2001, "\U0001f600")]
    return out


def test_against_brute_force(spark, monkeypatch):
    data = rows()
    assert run(spark, data) == sorted((brute(i, t) for i, t in data), key=str)
    assert run(spark, data, seed=9, rate=100, spm_rate=50) == sorted((brute(i, t, 9, 100, 50) for i, t in data), key=str)
    marks = ("[fim-prefix]", "[fim-suffix]", "[fim-middle]")
    assert run(spark, data, markers=marks) == sorted((brute(i, t, marks=marks) for i, t in data), key=str)
    assert run(spark, []) == []


def test_blocks_and_slices_do_not_matter(monkeypatch):
    """Every block length gives the same bytes, pieces and texts that span many blocks included."""
    texts = [t or "" for _, t in rows()]
    raw = [t.encode() for t in texts]
    off = np.r_[0, np.cumsum([len(t) for t in raw])].astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    h = fim.draws(list(range(len(raw))), 3)
    marks = fim.check_markers(fim.MARKERS)
    want = [brute(i, t, 3)[5].encode() for i, t in enumerate(texts)]
    for block in (1, 7, 64, 4096, 1 << 20) if len(data) < 10_000 else (997, 4096, 1 << 20):
        monkeypatch.setattr(fim, "BLOCK", block)
        out, to, n, form, a, b = fim.transform(data, off, h, marks, 90, 20)
        assert [out[x:y].tobytes() for x, y in zip(to[:-1], to[1:], strict=True)] == want
        back, at = fim.inverse(out, to, form, marks)
        assert (at == off).all() and (back == data).all()


def test_tiny_blocks(monkeypatch):
    texts = [t for t in ["", "a", "é€", "ab<", "P>x", "", "\U0001f600b\U0001f600"] * 9]
    raw = [t.encode() for t in texts]
    off = np.r_[0, np.cumsum([len(t) for t in raw])].astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    marks = fim.check_markers(fim.MARKERS)
    want = [brute(i, t, 3, 100, 50)[5].encode() for i, t in enumerate(texts)]
    for block in (1, 2, 3, 5):
        monkeypatch.setattr(fim, "BLOCK", block)
        out, to, _, form, _, _ = fim.transform(data, off, fim.draws(list(range(len(raw))), 3), marks, 100, 50)
        assert [out[x:y].tobytes() for x, y in zip(to[:-1], to[1:], strict=True)] == want
        back, at = fim.inverse(out, to, form, marks)
        assert (at == off).all() and back.tobytes() == data.tobytes()


def test_a_damaged_output_is_returned_as_it_is(spark):
    df = spark.createDataFrame([(1, "psm", "no marker"), (2, "spm", None), (3, None, "<P>a<S>c<M>b"), (4, "psm", "<P>a<S>c<M>b")], "doc_id long, form string, output string")
    assert sorted(tuple(r) for r in fim.restore(df).select("doc_id", "restored").collect()) == [(1, "no marker"), (2, ""), (3, "<P>a<S>c<M>b"), (4, "abc")]


@pytest.mark.parametrize("markers", [("<P>", "<S>"), ("<P>", "<P>", "<M>"), ("<P", "<P>", "<M>"), ("<<", "<S>", "<M>"), ("P", "S", ""), ("aP", "Pa", "x")])
def test_unsafe_markers_are_refused(markers):
    with pytest.raises(ValueError):
        fim.check_markers(markers)
