import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction

from rowlint.llm import mixing as M


def fill(budget, kids):
    """Water level over {name: (weight, capacity)}, in exact fractions."""
    kids = {k: v for k, v in kids.items() if v[0] > 0 and v[1] > 0}
    budget = min(budget, sum(c for _, c in kids.values()))
    full = set()
    while True:
        w = sum(kids[k][0] for k in kids if k not in full)
        left = budget - sum(kids[k][1] for k in full)
        more = {k for k in kids if k not in full and kids[k][1] * w <= left * kids[k][0]}
        if not more:
            break
        full |= more
    return {k: Fraction(kids[k][1]) if k in full else Fraction(left * kids[k][0], w) for k in kids}


def brute(leaves, weights, share, epochs):
    out = {}

    def down(path, budget):
        if len(path) == 3:
            out[path] = budget
            return
        kids = {}
        for leaf, tokens in leaves.items():
            if leaf[:len(path)] == path and all(weights[lv].get(x, M.DEFAULT_WEIGHT) > 0 for lv, x in zip(M.LEVELS, leaf, strict=True)):
                name = leaf[len(path)]
                kids[name] = (weights[M.LEVELS[len(path)]].get(name, M.DEFAULT_WEIGHT), kids.get(name, (0, 0))[1] + tokens * epochs)
        for name, given in fill(budget, kids).items():
            down((*path, name), given)

    down((), sum(leaves.values()) * share[0] // share[1])
    return out


WEIGHTS = {"domain": {"domain0": 5, "domain1": 0}, "lang": {"en": 3}, "source": {"src4": 2}}


def rows():
    random.seed(6)
    out = [(i, " ".join(["w"] * int(random.paretovariate(0.8))), random.choice(["en", "en", "de", "fr", None]), random.choice(["src0"] * 6 + [f"src{j}" for j in range(12)] + ["misc", None]))
           for i in range(400)]
    return out + [(1000, None, "en", "src0"), (1001, "", "en", "src2"), (None, "a b c", "en", "src0"), (1002, "only empty", "xx", None), (1003, "", "zz", "src3"), out[5]]


def domain(src):
    n = re.search("([0-9]+)$", src or "")
    return "(none)" if src is None else f"domain{int(n[1]) % M.DOMAINS}" if n else "other"


def run(spark, data, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in data], "doc_id long, text string, lang string, source string, domain string, copies int").repartition(3)
    return M.mix(df, WEIGHTS, **kw)


def test_shares_and_prefixes_against_brute_force(spark):
    data = rows()
    for share, epochs in (((1, 2), 2), ((1, 1), 1), ((3, 2), 4), ((0, 1), 2)):
        got = run(spark, data, share=share, max_epochs=epochs).collect()
        leaves = defaultdict(int)
        docs = defaultdict(list)
        for d, t, lang, src in data:
            leaf = (domain(src), lang or "(none)", src or "(none)")
            n = len((t or "").split())
            leaves[leaf] += n
            docs[leaf].append((d, n))
        want = brute(leaves, WEIGHTS, share, epochs)
        taken = defaultdict(list)
        for r in got:
            taken[r["domain"], r["lang"], r["source"]].append((r["row"]["doc_id"], r["tokens"], r["copies"]))
        ring = lambda d: hashlib.md5(f"{M.SEED}:{'' if d is None else d}".encode()).hexdigest()
        for leaf, tokens in leaves.items():
            given = want.get(leaf, Fraction(0))
            total = sum(n * c for _, n, c in taken[leaf])
            most = max((n for _, n in docs[leaf]), default=0)
            assert given - 3 <= total <= given + most + 3, (leaf, float(given), total)
            if not taken[leaf]:
                continue
            q = int((given + Fraction(1, 1000)) // tokens)
            start = M._offset(M.SEED, epochs)[min(q, epochs)]
            order = sorted(docs[leaf], key=lambda x: ((int(ring(x[0])[:3], 16) - start) % M.ARCS, ring(x[0]), x[1]))
            count = dict.fromkeys((d for d, _ in order), 0)
            for d, _, c in taken[leaf]:
                count[d] = c
            copies = [count[d] for d, _ in order]
            assert copies == sorted(copies, reverse=True) and max(copies) - min(copies) <= 1  # whole epochs and a prefix


def test_sums_are_exact(spark):
    random.seed(9)
    leaves = [(f"domain{i % 4}", random.choice("abc"), f"s{i}", random.randint(0, 10 ** 12)) for i in range(300)]
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
    given = M.allocate(df, M.LEVELS, M.WEIGHTS, (2, 3), 2).collect()
    assert sum(r["given"] for r in given) == sum(t for *_, t in leaves) * 2 // 3
    assert all(0 <= r["given"] <= 2 * r["tokens"] for r in given)


def test_empty_table_and_columns(spark):
    got = run(spark, [])
    assert got.collect() == [] and got.columns == ["row", "domain", "lang", "source", "tokens", "copies"]
