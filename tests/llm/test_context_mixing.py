import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from rowlint.llm import context_mixing as C


def tokens(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [x for x in low.split(" ") if x] + [None]


def base(rows):
    train = [tokens(t) for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 10]
    c = Counter(x for t in train for x in t)
    n, v = sum(c.values()), len(c)
    out = []
    for d, t in rows:
        own = tokens(t)
        out.append((d, d is not None and zlib.crc32(str(d).encode()) % 10 == 0, len(own), sum(c[x] > 0 for x in own), n,
                    sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in own)))
    return out


def corpus():
    random.seed(3)
    vocabulary = ["".join(random.choice("abcdeéßz") for _ in range(random.randint(1, 6))) for _ in range(400)]
    rows = [(i, " ".join(random.choice(vocabulary) for _ in range(random.randint(0, 60)))) for i in range(200)]
    return rows + [(500, None), (501, ""), (502, "A b\x1cc É\tx\r\ny"), (None, "no id here"), (3, rows[3][1]), (503, "z " * 60000), (504, "\U0001f600" * 50)]


@pytest.mark.parametrize("heavy", [C.HEAVY, 20])
def test_base_score_against_brute_force(spark, monkeypatch, heavy):
    monkeypatch.setattr(C, "HEAVY", heavy)
    rows = corpus()
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, h string, uid int").repartition(4)
    got = C.with_lm_scores(df).collect()
    want = sorted(base(rows), key=str)
    have = sorted([tuple(r)[:6] for r in got], key=lambda r: str((r[0], r[1], r[2], r[3])))
    want.sort(key=lambda r: str((r[0], r[1], r[2], r[3])))
    for a, b in zip(have, want, strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
    assert all(r["score"] < 0 for r in got)
    empty = [r for r in got if r["n_tokens"] == 1]
    assert empty and all(r["bits_per_byte"] is None for r in empty if r["doc_id"] in (500, 501))


def model(texts):
    data = [C.lowered(t) for t in texts]
    code = C.make_code(np.bincount(np.frombuffer(b"".join(data), np.uint8), minlength=256), data)
    counts = [np.zeros(1 << (C.SLOT_BITS + 6), np.int64) for _ in C.ORDERS]
    s, first, _ = C.stream(data, code)
    at = C._real(s, first) - C.PAD
    rank, rows = C.contexts(s, code)
    for t, b in zip(counts, rows, strict=True):
        np.add.at(t, b[at] + rank[at], 1)
    depth = len(code.step)
    m = C.Model(code, C.tables_from(counts, code), np.full((depth, len(C.ORDERS)), 0.35 / C.UNIT, np.float32), np.ones((depth, C.BINS, 2)))
    m.settle()
    return m


def test_scores_do_not_depend_on_neighbours():
    texts = [t or "" for _, t in corpus()][:60]
    m = model(texts)
    data = [C.lowered(t) for t in texts]
    together = m.bits(data)
    alone = np.array([m.bits([t])[0] for t in data])
    assert np.allclose(together, alone, rtol=1e-4)


def test_updates_come_every_block_of_every_text(monkeypatch):
    texts = [C.lowered(t or "") for _, t in corpus()][:60]
    m = model([t.decode() for t in texts])
    seen = []
    block = C.Model._block

    def spy(self, who, learns, lo, hi, *rest):
        seen.append((hi - lo, learns, set(who.tolist())))
        return block(self, who, learns, lo, hi, *rest)

    monkeypatch.setattr(C.Model, "_block", spy)
    long = [b"zzzzz ab " * 25, b"q" * 5000]
    m.bits(long)
    assert {n for n, _, _ in seen} == {C.BLOCK} and C.BLOCK <= 32
    # a text learns after every block that is not its last
    assert [sum(i in who and learns for _, learns, who in seen) for i in (0, 1)] == [len(t) // C.BLOCK for t in sorted(long, key=len)]
    # a text of less than 256 symbols that repeats itself gets cheaper than without learning
    learned = m.bits(long[:1])[0]
    monkeypatch.setattr(C, "BLOCK", 1 << 20)
    assert learned < m.bits(long[:1])[0]


def plain_bits(m, text):
    """Bits of one text, decision by decision, updates after every block."""
    raw = [int(m.code.symbol[b]) for b in text] + [C.END]
    w, apm, total = m.weights.astype(np.float32), m.apm.astype(np.float32), sum(m.code.escape_bits[b] for b in text)
    back = [C.END] * C.PAD + raw
    for lo in range(0, len(raw), C.BLOCK):
        step_w, hits, met = np.zeros(w.shape), [], Counter()
        for i in range(lo, min(lo + C.BLOCK, len(raw))):
            before = back[i:i + C.PAD][::-1]
            number = {o: sum(x << 6 * j for j, x in enumerate(before[:o])) for o in C.ORDERS}
            rank = int(m.code.rank[m.code.row[number[3]] * 64 + raw[i]])
            slots = [(number[o] * C._R % (1 << 64)) >> (64 - C.SLOT_BITS) for o in C.ORDERS]
            for d in range(len(m.code.step)):
                step = int(m.code.step[d, rank])
                node, bit = step & 63, (step >> 6) & 1
                odds = np.array([t[slot * 64 + node] for t, slot in zip(m.tables, slots, strict=True)], np.float32)
                x = float(w[d] @ odds)
                p = 1 / (1 + math.exp(-x))
                cell = int(min(max(x * C.BINS / 16 + C.BINS / 2, 0), C.BINS - 1))
                f = (apm[d, cell, 1] / apm[d, cell].sum() + p) / 2
                total -= math.log2(max(f if bit else 1 - f, 1e-6))
                step_w[d] += (bit - p) * odds
                met[d] += 1
                hits.append((d, cell, bit))
                if step >= C.LAST:
                    break
        for d, n in met.items():
            w[d] += C.RATE / C.UNIT ** 2 / (n + 64) * step_w[d]
        for h in hits:
            apm[h] += 1
    return total


def test_bits_against_decisions_one_by_one(monkeypatch):
    """Texts of no, one and many blocks, worked on in parts of two texts."""
    texts = [C.lowered(t or "") for _, t in corpus()][:60]
    m = model([t.decode() for t in texts])
    own = [b"", b"a", b"b" * (C.BLOCK - 1), b"c" * C.BLOCK, b"zz ab " * 25, texts[1], texts[2], "\U0001f600 not seen".encode()]
    whole = m.bits(own)
    assert whole == pytest.approx([plain_bits(m, t) for t in own], rel=1e-4)
    monkeypatch.setattr(C, "SIDE", 2 * C.BLOCK)
    assert (m.bits(own) == whole).all()


def test_counting_looks_up_different_sevens_only(monkeypatch):
    texts = [C.lowered(t or "") for _, t in corpus()][:30] * 10
    m = model([t.decode() for t in texts])
    s, first, _ = C.stream(texts, m.code)
    every = C._real(s, first)
    sevens, times = np.unique(np.stack([s[every - j] for j in range(C.PAD + 1)]), axis=1, return_counts=True)
    want = np.zeros(len(m.code.step) * 2 * C.CELLS, np.int64)
    rank, rows = C.contexts(s, m.code)
    levels = m.levels()
    for i in (every - C.PAD)[:len(every) // 10].tolist():
        for d, step in enumerate(m.code.step[:, rank[i]].tolist()):
            cell = 2 * d + ((step >> 6) & 1)
            for level, r in zip(levels, rows, strict=True):
                cell = (cell << C.LEVEL_BITS) | int(level[r[i] + (step & 63)])
            want[cell] += 10
            if step >= C.LAST:
                break
    seen, looked_up = [], C.looked_up
    monkeypatch.setattr(C, "looked_up", lambda key, code: (seen.append(len(key)), looked_up(key, code))[1])
    got = np.zeros(len(want), np.uint32)
    m.decisions(texts, got, m.levels())
    assert (got == want).all()
    assert sum(seen) == sevens.shape[1] < len(every) / 10
    # in parts, each counted by itself
    monkeypatch.setattr(C, "SORTED", 1000)
    monkeypatch.setattr(C, "SIDE", 64)
    again = np.zeros(len(want), np.uint32)
    m.decisions(texts, again, m.levels())
    assert (again == want).all()
    assert sum(n.sum() for _, n in C.distinct(texts, m.code)) == times.sum() == len(every)


def test_probabilities_sum_to_one():
    # every symbol after the same text: the chances of all next symbols add up
    m = model([t or "" for _, t in corpus()][:60])
    start = b"abc d"
    before = m.bits([start])[0]
    total = 0.0
    end = 2.0 ** -before  # the text ends here
    stop = {}
    for b in range(256):
        if m.code.symbol[b] == C.ESCAPE and C.ESCAPE in stop:
            continue
        stop[int(m.code.symbol[b])] = b
    # decisions of a rank: the code is complete, so its lengths fill the unit interval
    lengths = [next(d for d in range(len(m.code.step)) if m.code.step[d, s] >= C.LAST) + 1 for s in range(64)]
    total = sum(2.0 ** -n for n in lengths)
    assert total == pytest.approx(1.0) and 0 < end < 1
    assert sorted(m.code.rank.reshape(-1, 64)[17]) == list(range(64))
    lost = sum(2.0 ** -m.code.escape_bits[b] for b in range(256) if m.code.symbol[b] == C.ESCAPE)
    assert lost == pytest.approx(1.0)


def test_the_fit_sees_the_decisions_of_every_training_text(spark, monkeypatch):
    """Long texts and every short one, in whatever partitions; held-out ones have no part."""
    rows = [(i, f"text number {i} of the lot " * (i % 7)) for i in range(300)] + [(1001, "a long one of its own, " * 12_000), (1002, "another " * 30_000)]
    seen, fit = [], C.Model.fit
    monkeypatch.setattr(C.Model, "fit", lambda self, decisions: (seen.append((self, decisions.copy())), fit(self, decisions))[1])
    held = [zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    df = spark.createDataFrame([(d, t, h) for (d, t), h in zip(rows, held, strict=True)], "id long, text string, held boolean").repartition(3)
    C.train(df)
    (m, got), = seen
    want = np.zeros(len(got), np.uint32)
    m.decisions([C.lowered(t) for (_, t), h in zip(rows, held, strict=True) if not h], want, m.levels())
    assert (got == want).all()
    # every symbol takes one first decision
    assert got[:2 * C.CELLS].sum() == sum(len(t) + 1 for (_, t), h in zip(rows, held, strict=True) if not h)


def test_fitted_weights_are_of_most_likelihood():
    texts = [C.lowered(t or "") for _, t in corpus()][:150]
    m = model([t.decode() for t in texts])
    total = np.zeros(len(m.code.step) * 2 * C.CELLS, np.uint32)
    m.decisions(texts, total, m.levels())
    before = m.bits(texts).sum()
    m.apm = np.ones_like(m.apm)
    m.fit(total.astype(np.int64))
    assert np.isfinite(m.weights).all() and m.bits(texts).sum() < before


def test_learns_the_language(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = C.with_lm_scores(df).where("held_out").toPandas()
    bits = -out["score"].sum() / math.log10(2)
    size = (-out["score"] / math.log10(2) / out["bits_per_byte"]).sum()
    assert bits / size < 3.2  # 8 for a uniform model


def test_empty_table(spark):
    assert C.with_lm_scores(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_only_held_out_rows(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = C.with_lm_scores(spark.createDataFrame([(held, "two words")], "doc_id long, text string")).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (3, 0, 0)


def test_words_of_many_texts(monkeypatch):
    texts = [C.lowered(t or "") for _, t in corpus()] + [b"same same", b"x" * 5000 + b" same"]
    ids, count = C.word_ids(texts)
    assert count.tolist() == [len(t.split()) + 1 for t in texts]
    name = {}
    for h, w in zip(ids.tolist(), [x for t in texts for x in [*t.split(), None]], strict=True):
        assert name.setdefault(w, h) == h
    assert len(set(name.values())) == len(name)
    monkeypatch.setattr(C, "SEGMENT", 64)
    assert (C.word_ids(texts)[0] == ids).all()
