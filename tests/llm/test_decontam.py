import random

from rowlint.llm.decontam import RATE, Matcher, budget, decontaminate, myers, normal, with_matches


def distance(item, text):
    """Smallest edit distance of item to a part of text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def masks(item):
    m = {}
    for i, c in enumerate(item):
        m[c] = m.get(c, 0) | 1 << i
    return m


def test_myers_against_table():
    random.seed(2)
    for _ in range(400):
        item = "".join(random.choice("abc") for _ in range(random.randint(1, 70)))
        text = "".join(random.choice("abc") for _ in range(random.randint(0, 90)))
        assert myers(item, text, masks(item))[0] == min(distance(item, text), len(item))


def spoil(s, n):
    for _ in range(n):
        i = random.randrange(len(s))
        s = random.choice([s[:i] + s[i + 1:], s[:i] + "q" + s[i:], s[:i] + "z" + s[i + 1:]])
    return s


def test_matches_against_brute_force():
    random.seed(4)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(random.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(random.randint(1, 25)))) for i in range(25)]
    m = Matcher(items, 0.1)
    for _ in range(150):
        i, item = random.choice(items)
        text = " ".join([*(word() for _ in range(8)), spoil(item, random.randint(0, max(1, len(item) // 7))) or "x", *(word() for _ in range(8))])
        t = normal(text)
        want = {j: distance(normal(x), t) for j, x in items if distance(normal(x), t) <= budget(len(normal(x)), 0.1)}
        got = m.find(text)
        assert {j: d for j, d, _, _ in got} == want
        for j, d, a, b in got:
            x = normal(dict(items)[j])
            row = list(range(len(t[a:b]) + 1))
            for p, c in enumerate(x, 1):
                new = [p]
                for q, e in enumerate(t[a:b], 1):
                    new.append(min(row[q] + 1, new[-1] + 1, row[q - 1] + (c != e)))
                row = new
            assert row[-1] == d


ITEM = "The quick brown fox jumps over the lazy dog and runs far away into the woods tonight."


def test_edge_cases(spark):
    items = spark.createDataFrame([(1, ITEM), (2, None), (None, "lonely item without id"), (3, ""), (1, "another text of item one which is long enough"), (1, ITEM)],
                                  "item_id long, text string")
    docs = [(1, "before " + ITEM.upper().replace(" ", "\n") + " after"), (2, ITEM.replace("quick", "quikc")), (3, "clean text"), (4, None), (5, ""),
            (6, "w " * 200000 + ITEM), (None, ITEM), (1, "repeated id, clean"), (8, "lonely item without id")]
    df = spark.createDataFrame([(d, t, "m") for d, t in docs], "doc_id long, text string, matches string")
    for block in (4_000_000, 20):
        out = with_matches(df, items, block_chars=block)
        assert out.columns == df.columns
        got = {(r["doc_id"], r["text"]): [(x["item_id"], x["distance"]) for x in r["matches"]] for r in out.collect()}
        assert got == {d: [(1, {2: 2}.get(d[0], 0))] if d[1] and "fox" in d[1].lower() else [] for d in docs}
    # an item without id has no entry above, but what holds it goes
    kept = [(r["doc_id"], r["text"]) for r in decontaminate(df, items).collect()]
    assert sorted(kept, key=str) == sorted([docs[2], docs[3], docs[4], docs[7]], key=str)
    assert sorted(((r["doc_id"], r["text"]) for r in decontaminate(df, items, block_chars=20).collect()), key=str) == sorted(kept, key=str)
    assert decontaminate(df, items.limit(0)).count() == len(docs)
    assert decontaminate(df.limit(0), items).count() == 0
    assert RATE <= 0.1
