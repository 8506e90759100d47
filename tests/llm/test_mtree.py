import math
import random

import numpy as np
from pyspark.sql import functions as F

from rowlint.llm.mtree import Tree, query_groups, top_k, tree_copies


def brute(rows, k, ask):
    clean = {(i, tuple(math.floor(256 * float(x)) for x in v)) for i, v in rows
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, v in clean:
        if ask(q):
            c = sorted(((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in clean if i != q and len(w) == len(v)))[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(c, 1)]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 1.0, "x") for i, v in rows], "vec_id long, embedding array<float>, score double, cell string")
    return sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 10 == 0, **kw).collect())


def test_against_brute_force(spark):
    random.seed(1)
    f = lambda: float(np.float32(random.gauss(0, 0.3)))
    rows = [(i, [f() for _ in range(8)]) for i in range(700)]
    rows += [(1000 + i, [0.5] * 8) for i in range(300)]  # one very common vector: ties
    rows += [(2000 + i, [f(), f()]) for i in range(3)]  # another length, fewer than k
    rows += [(3000, None), (3010, []), (3020, [0.1, None]), (3030, [float("nan")] * 8), (3040, [float("inf")] * 8), (None, [0.5] * 8), rows[0], (3050, [0.0] * 8)]
    want = brute(rows, 5, lambda q: q % 10 == 0)
    assert run(spark, rows) == want
    assert run(spark, rows, block_rows=50) == want
    assert run(spark, rows, block_rows=64, max_pivots=2) == want


def test_empty(spark):
    assert run(spark, []) == [] and run(spark, [(1, None)]) == [] and run(spark, [(3, [1.0]), (4, [1.0])]) == []


def test_bounds_leave_work_out():
    rng = np.random.default_rng(0)
    centers = rng.normal(0, 60, (12, 16))
    x = np.floor(np.concatenate([c + rng.normal(0, 2, (200, 16)) for c in centers])).astype(np.int64)
    tree = Tree(np.arange(len(x)), x, float((x * x).sum(1).max()))
    looked = []
    tree.vectors = Counted(tree.vectors, looked)
    got = tree.search(x[0], 0, 5)
    want = sorted(((-int(s), i) for i, s in enumerate((x @ x[0]).astype(int)) if i))[:5]
    assert got == [(-s, i) for s, i in want] and sum(looked) < len(x)


def test_scores_beyond_the_precision_of_floats():
    rng = np.random.default_rng(3)
    for scale, dim in ((10**5, 8), (10**6, 4), (10**8, 16), (4 * 10**9, 3)):
        x = rng.integers(-scale, scale, (400, dim))
        x[200:220] = x[0] + rng.integers(0, 2, (20, dim))  # nearly the same score
        tree = Tree(np.arange(len(x)), x, float((x.astype(float) ** 2).sum(1).max()))
        for q in (0, 5, 210):
            want = sorted((-sum(int(a) * int(b) for a, b in zip(x[q], v, strict=True)), i) for i, v in enumerate(x) if i != q)[:5]
            assert tree.search(x[q], q, 5) == [(-s, i) for s, i in want]
            assert tree.search(x[q], q, 5, -want[2][0]) == [(-s, i) for s, i in want if s <= want[2][0]]


def test_large_components_against_brute_force(spark):
    random.seed(8)
    rows = [(i, [float(random.randrange(-4000, 4000)) for _ in range(4)]) for i in range(300)]  # times 256: a million
    rows += [(1000 + i, [3999.0, 3998.0, float(-i), 1.0]) for i in range(20)]
    assert run(spark, rows, block_rows=30) == brute(rows, 5, lambda q: q % 10 == 0)


def test_hundreds_of_blocks_in_one_plan(spark):
    random.seed(9)
    f = lambda: float(np.float32(random.gauss(0, 0.3)))
    rows = [(i, [f() for _ in range(4)]) for i in range(2600)]
    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 200 == 0, block_rows=4).collect())
    assert got == brute(rows, 5, lambda q: q % 200 == 0)


def test_trees_go_only_where_queries_ask(spark):
    block = ["dim", "cell", "block"]
    queries = spark.createDataFrame([(1, 0, 0, i) for i in range(10)] + [(1, 2, 5, 99)], "dim int, cell int, block long, query_id long")
    trees = spark.createDataFrame([(1, c, b, b"t") for c in range(3) for b in range(6)], "dim int, cell int, block long, tree binary")
    need = query_groups(queries, block, 4)
    copies = sorted((r["cell"], r["block"], r["g"]) for r in tree_copies(trees, need, block).collect())
    assert copies == [(0, 0, 0), (0, 0, 1), (0, 0, 2), (2, 5, 0)]


class Counted:
    def __init__(self, a, looked):
        self.a, self.looked = a, looked

    def __getitem__(self, rows):
        self.looked.append(len(rows))
        return self.a[rows]
