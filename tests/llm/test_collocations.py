import random
import re
from collections import Counter

import numpy as np
import pytest

from rowlint.llm import collocations as C


def brute(rows, min_count=10, contained=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            ws = re.findall("[^ \t]+", piece)
            n[lang] += len(ws)
            for k in (1, 2, 3):
                for i in range(len(ws) - k + 1):
                    f[lang, tuple(ws[i:i + k])] += 1
    out = []
    long = [(k, v) for k, v in f.items() if len(k[1]) == 3 and v >= min_count]
    held = Counter()
    for (lang, w), v in long:
        for part in (w[:2], w[1:]):
            held[lang, part] = max(held[lang, part], v)
    for (lang, w), a in f.items():
        if len(w) == 1 or a < min_count or (len(w) == 2 and (lang, w) in held and 100 * held[lang, w] >= contained * a):
            continue
        cuts = [(1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
        s, _, le, r = min(cuts)
        out.append((lang, -s, -a, " ".join(w).encode(), le, r))
    out.sort()
    rank, res = Counter(), []
    for lang, s, a, w, le, r in out:
        rank[lang] += 1
        if rank[lang] <= top:
            res.append((lang, rank[lang], w.decode(), -a, le, r, n[lang], -s))
    return res


def corpus():
    random.seed(2)
    words = ["new", "york", "city", "of", "The", "é", "ab c", "x"]
    say = lambda k: "".join(random.choice(words) + random.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for _ in range(k))
    rows = [("en", say(random.randrange(60))) for _ in range(60)] + [("de", say(40)) for _ in range(20)] + [(None, say(80)) for _ in range(5)]
    rows += [("en", None), ("en", ""), ("fr", ""), ("en", "a a a a a a a a a a a a a"), ("und", say(30)), rows[0], rows[0], ("en", "new york city " * 3000)]
    return rows


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, a int, phrase string").repartition(3)
    return sorted(tuple(r) for r in C.collocations(df, **kw).collect())


@pytest.mark.parametrize("kw", [{}, {"shard": 50, "bucket": 64}, {"min_count": 2, "contained": 80, "top": 7, "shard": 300}])
def test_against_brute_force(spark, kw):
    rows = corpus()
    ours = {k: v for k, v in kw.items() if k not in ("shard", "bucket")}
    assert run(spark, rows, **kw) == sorted(brute(rows, **ours))


def test_a_text_longer_than_its_shard(spark, monkeypatch):
    """Phrases across the border of two shards count once, whatever the border."""
    random.seed(4)
    text = "".join(random.choice(["a", "b", "c"]) + random.choice([" ", " ", " ", ". "]) for _ in range(900))
    want = sorted(brute([("en", text), ("en", "a b c")], 2))
    for block, shard in ((3, 5), (1, 1), (40, 17), (64, 1 << 20)):
        made = C._shards(shard, 2)
        monkeypatch.setattr(C, "BLOCK", block)
        assert sorted(_local(made, [("en", text), ("en", "a b c")])) == want


def _local(made, rows):
    """The operator's own steps without Spark, for many small shards."""
    import pandas as pd
    import pyarrow as pa

    class Ctx:
        @staticmethod
        def get():
            return Ctx

        partitionId = staticmethod(lambda: 0)

    old, C.TaskContext = C.TaskContext, Ctx
    try:
        batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1].encode() for r in rows])], ["lang", "text"])
        out = pa.Table.from_batches(list(made(iter([batch])))).to_pandas()
    finally:
        C.TaskContext = old
    w = out[out.kind == "w"].copy()
    w = w.astype({"lid": int, "shard": int, "c": int})
    w["own"] = w["shard"] * (1 << C.LID_BITS) + w["lid"]
    w["f"] = w.groupby(["lang", "word"])["c"].transform("sum").astype(int)
    w["gid"] = w.groupby(["lang", "word"])["own"].transform("min")
    w = w[w.f >= 2]
    blobs = [C._phrases(3, 8)((s,), out[(out.kind == "s") & (out["shard"] == s)], w[w["shard"] == s]) for s in out["shard"].unique()]
    grams = pd.concat([C._sums(2)(g) for _, g in pd.concat(blobs).groupby("bucket")])
    names = w[w.own == w.gid].set_index("gid")
    n = int(out[out.kind == "w"]["c"].sum())
    f = {(names.word[r.a], names.word[r.b]) + ((names.word[r.c],) if r.c else ()): r.f for r in grams.itertuples()}
    f |= {(r.word,): r.f for r in names.itertuples()}
    res = []
    for p, a in f.items():
        if len(p) == 1 or len(p) == 2 and any(100 * v >= 50 * a for q, v in f.items() if len(q) == 3 and p in (q[:2], q[1:])):
            continue
        s, _, le, r = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
        res.append((-s, -a, " ".join(p), le, r))
    return [("en", i, p, -a, le, r, n, -s) for i, (s, a, p, le, r) in enumerate(sorted(res), 1)]


def test_index_counts_every_phrase():
    rng = np.random.default_rng(0)
    for size in (1, 3, 40):
        x = np.r_[0, 0, rng.integers(0, size + 1, 500), 0, 0]
        index = C.Index(x, size)
        a, b, place, count = index.pairs()
        want = Counter((p, q) for p, q in zip(x, x[1:], strict=False) if p and q)
        assert dict(zip(zip(a.tolist(), b.tolist(), strict=True), count.tolist(), strict=True)) == want
        pair, c, n = index.triples(place, count)
        want = Counter(t for t in zip(x, x[1:], x[2:], strict=False) if all(t))
        assert {(int(a[p]), int(b[p]), int(t)): int(k) for p, t, k in zip(pair, c, n, strict=True)} == want


def test_empty(spark):
    assert run(spark, []) == [] and run(spark, [("en", None), (None, "")]) == [] and run(spark, [("en", ". , ;")]) == []


def test_products_beyond_64_bits(spark):
    row = spark.sql(f"SELECT {C._SCORE.format(l='l', r='r')} AS s FROM VALUES (3000000000000L, 3000000000001L, 4000000000000L) AS t(a, l, r)").first()
    assert row["s"] == 10**6 * 3000000000000**2 // (3000000000001 * 4000000000000)


def test_a_hot_first_word_is_dealt_by_the_second():
    a, b = np.full(1000, 7), np.arange(1000)
    assert len(np.unique(C.buckets(a, b, np.full(1000, 10**6), 50, 10**4))) > 30
    assert len(np.unique(C.buckets(a, b, np.full(1000, 10), 50, 10**4))) == 1


def test_packed_integers_come_back():
    for x in ([], [0], [5, 1, 1 << 30], [1 << 40, 3], [-1, 4]):
        assert C.unpack(C.pack(np.array(x, np.int64))).tolist() == x
