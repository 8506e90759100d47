import random

import numpy as np
import pytest

from rowlint.llm import near_dedup as N


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_similarity_against_plain_alignment():
    random.seed(1)
    for _ in range(300):
        a = [random.randrange(30) for _ in range(random.randint(0, 80))]
        b = [x for x in a if random.random() > 0.08]
        for _ in range(random.randint(0, 4)):
            b.insert(random.randint(0, len(b)), random.randrange(30))
        n = lcs(a, b)
        want = n / (len(a) + len(b) - n) if a and b else 0.0
        got = N.similarity(np.array(a, np.uint32), np.array(b, np.uint32))
        assert got == (want if want >= 0.8 else 0.0)


def texts():
    random.seed(7)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = " ".join(random.choice(vocabulary) for _ in range(60))
    out = []
    for _ in range(40):
        words = [random.choice(vocabulary) for _ in range(random.randint(5, 200))]
        out.append(" ".join(words))
        for _ in range(random.randint(0, 4)):  # near copies
            copy = list(words)
            for _ in range(random.randint(0, 4)):
                copy[random.randrange(len(copy))] = random.choice(vocabulary)
            out.append(" ".join(copy))
    out += [" ".join(random.choice(vocabulary) for _ in range(70)) + " " + passage for _ in range(150)]  # a common passage
    hot = [random.choice(vocabulary) for _ in range(140)]
    for _ in range(120):  # a large group around the threshold
        copy = list(hot)
        for _ in range(random.randint(1, 3)):
            copy[random.randrange(len(copy))] = random.choice(vocabulary)
        out.append(" ".join(copy))
    return out + [out[0], out[0].upper(), "", None, " \n", "one two", "One  two", "one two three", None]


def brute(rows):
    s = [N.shingles(N.word_hashes(t or "")) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (not len(s[i]) and not len(s[j])) or N.similarity(s[i], s[j]) > 0:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(rows))]


def test_classes_against_brute_force(spark):
    rows = list(enumerate(texts()))
    random.shuffle(rows)
    rows += [(None, rows[0][1]), (None, "a text of its own without any id at all"), (rows[1][0], rows[1][1])]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, uid int, k int").repartition(5)
    got = sorted(((r["doc_id"], r["class_id"]) for r in N.near_duplicates(df).collect()), key=str)
    want = brute(rows)
    assert got == sorted(zip((d for d, _ in rows), want, strict=True), key=str)
    kept = N.keep_first(df)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(d for (d, _), c in zip(rows, want, strict=True) if d is not None and d == c) and ids.count(None) == 2


def edited(sizes):
    """Texts of the given numbers of words, each with copies that have words inserted or deleted."""
    random.seed(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    out = []
    for n in sizes:
        words = [random.choice(vocabulary) for _ in range(n)]
        out += [words, [*words, "more"], words[1:], ["more", *words], words[:n // 2] + words[n // 2 + 1:], words[:n // 2] + ["more"] + words[n // 2:]]
    return [" ".join(w) for w in out]


def test_sketches_meet_across_lengths():
    made = edited(list(range(38, 75)))
    for i in range(0, len(made), 6):
        s = [N.shingles(N.word_hashes(t)) for t in made[i:i + 6]]
        for j in range(1, 6):
            if N.similarity(s[0], s[j]) > 0:
                assert np.intersect1d(N.sketches(s[0]), N.sketches(s[j])).size


def test_insertions_and_deletions_against_brute_force(spark):
    rows = list(enumerate(edited([40, 41, 42, 44, 45, 46, 62, 63, 64, 65, 66, 67, 68, 69] * 3)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["class_id"]) for r in N.near_duplicates(df).collect())
    assert got == sorted(zip((d for d, _ in rows), brute(rows), strict=True))


def test_exhaustive_finds_every_class(spark, monkeypatch):
    """All pairs that share a bucket, in blocks smaller than the buckets."""
    monkeypatch.setattr(N, "BLOCK", 3)
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["class_id"]) for r in N.near_duplicates(df, rounds=1, partners=1, exhaustive=True).collect())
    assert got == sorted(zip((d for d, _ in rows), brute(rows), strict=True))


def group(n, changes, words=200, seed=3):
    """Texts of one origin, each with so many words replaced."""
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [random.choice(vocabulary) for _ in range(words)]
    out = []
    for i in range(n):
        copy = list(base)
        for at in random.sample(range(words), changes[i % len(changes)]):
            copy[at] = random.choice(vocabulary)
        out.append(" ".join(copy))
    return out


def same_class(classes):
    members = {}
    for i, c in enumerate(classes):
        members.setdefault(c, []).append(i)
    return sum(len(m) * (len(m) - 1) // 2 for m in members.values())


@pytest.mark.parametrize("changes", [(2,), (1, 2, 3), (2, 3)])
def test_class_links_in_a_group_around_the_threshold(spark, changes):
    """Pairs of the group are 0.73 to 0.9 alike: of the pairs in one class by brute force, 0.9 are found at least, and none else."""
    rows = list(enumerate(group(300, changes)))
    want = brute(rows)
    got = [c for _, c in sorted(tuple(r) for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())]
    assert all(want[i] == want[c] for i, c in enumerate(got))
    assert same_class(got) >= 0.9 * same_class(want) > 0


@pytest.mark.parametrize("block", [7, 512])
def test_no_link_is_lost_in_a_group_around_the_threshold(spark, monkeypatch, block):
    """Groups whose pairs are nearly all below the threshold, beside one that has a large component."""
    monkeypatch.setattr(N, "BLOCK", block)
    made = group(250, (3,)) + group(150, (2, 3), seed=4) + group(60, (1,), words=30, seed=5)
    rows = [(i * 7 % 1000, t) for i, t in enumerate(made)]
    for query in (N.near_duplicates, lambda docs: N.near_duplicates(docs, rounds=0)):
        got = sorted(tuple(r) for r in query(spark.createDataFrame(rows, "doc_id long, text string")).collect())
        assert got == sorted(zip((d for d, _ in rows), brute(rows), strict=True))
    kept = [r["doc_id"] for r in N.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(kept) == sorted({c for _, c in got})


def test_folded_counts_rule_out_no_link():
    random.seed(9)
    for i in range(200):
        a = [random.randrange(40) for _ in range(random.randint(1, 90))] * random.choice([1, 1, 8])
        b = [x for x in a if random.random() > 0.1]
        x, y = np.array(a, np.uint32), np.array(b, np.uint32)
        bins = next(N._folded([N.pd.DataFrame({"uid": [1, 2], "seq": [x.tobytes(), y.tobytes()]})]))["bins"]
        rows = N.pd.DataFrame({"k": 5, "i": 0, "j": i % 2, "g": [0, i % 2], "uid": [1, 2], "n": [len(a), len(b)], "label": [1, 2], "sk": [[5], [5]], "bins": bins})
        assert len(N._possible(rows, 0.8)) or not N.similarity(x, y)


@pytest.mark.parametrize("changes", [3, 4])
def test_comparisons_of_a_text_do_not_grow_with_its_group(spark, monkeypatch, changes):
    per_text = {}
    plain = N.written
    for n in (150, 600):
        counts = []

        def counted(df, name, counts=counts):
            out = plain(df, name)
            if name.startswith("pairs"):
                counts.append(out.count())
            return out

        monkeypatch.setattr(N, "written", counted)
        N.near_duplicates(spark.createDataFrame(list(enumerate(group(n, (changes,)))), "doc_id long, text string"), rounds=2, partners=4).count()
        assert max(counts) <= 4 * n
        per_text[n] = max(counts) / n  # of one round; there are as many rounds as add links, and no more than `rounds`
    assert per_text[600] < 1.3 * per_text[150]


def test_alignment_of_long_texts_needs_linear_memory():
    import tracemalloc

    rng = np.random.default_rng(5)
    peaks = {}
    for n in (30_000, 300_000):
        a = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        b = np.delete(a, rng.integers(0, n, n // 100))
        b[rng.integers(0, len(b), n // 100)] = 7
        tracemalloc.start()
        s = N.similarity(a, b)
        peaks[n] = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert 0.95 < s < 0.985
    assert peaks[300_000] < 15 * peaks[30_000] and peaks[300_000] < 250 << 20


def test_alignment_of_repeated_words(monkeypatch):
    """Items of many places, with and without rows of their own."""
    random.seed(2)
    for common in (0, 3, 512):
        monkeypatch.setattr(N, "COMMON", common)
        for _ in range(120):
            a = [random.randrange(4) for _ in range(random.randint(1, 120))]
            b = [x for x in a if random.random() > 0.05]
            for _ in range(random.randint(0, 3)):
                b.insert(random.randint(0, len(b)), random.randrange(4))
            if not b:
                continue
            n = lcs(a, b)
            want = n / (len(a) + len(b) - n)
            assert N.similarity(np.array(a, np.uint32), np.array(b, np.uint32)) == (want if want >= 0.8 else 0.0)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 105), (105, 103)], "a long, b long")
    got = {r["uid"]: r["label"] for r in N.components(edges, "chain").collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 103: 100, 105: 100}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert N.near_duplicates(df).collect() == [] and N.keep_first(df).collect() == []
