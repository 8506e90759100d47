"""Exact top-k inner products by best-first search in M-trees.

Largest inner product becomes nearest neighbour: with ``M`` the largest norm,
a vector x gets one more coordinate ``sqrt(M^2 - |x|^2)`` and a query gets 0, so
that ``d(q, x)^2 = |q|^2 + M^2 - 2 q.x``.  In that metric space the rows are
dealt to cells around pivots (a bounded, documented sample of rows; every row
is indexed), cells are cut into blocks of bounded size by the distance from
their pivot, and each block is an M-tree: pages of routing objects with covering
radii and distances to their parent, leaf pages of vectors with their parent
distance.

A search pops pages by their least possible distance and ends when that
exceeds the k-th distance so far.  Before any distance is computed, the stored
parent distances rule entries out by the triangle inequality.  Comparisons leave
a slack above rounding error, taken from the vectors' lengths, and scores are
exact integers, so results are exact, ties included.

Every query first searches its own block, which gives it a bound; blocks whose
ring around their pivot lies beyond the bound are then left out, and the query
goes to the others.  The queries of a block meet its tree in groups of bounded
size, and a tree goes only where queries ask for it.
"""

from __future__ import annotations

import heapq
import math
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import col, written

K = 5
SCALE = 256
BLOCK_ROWS = 8192
LEAF = 128
FANOUT = 16
MAX_PIVOTS = 512  # the sample that the cells are fitted on; all rows are indexed
RINGS = 4096  # steps of distance that a cell is cut at
QUERY_GROUP = 4096
HITS = "query_id long, vec_id long, score long"


def quantized(v: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, or null where the vector is null,
    empty, or has a null or non-finite component."""
    ok = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(ok, F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def slack(q2: float, m2: float) -> float:
    """More than rounding can move a distance: the root of what it can move a squared one."""
    return 8 * math.sqrt(1e-13 * (q2 + m2)) + 1e-9


def exact_scores(vectors: np.ndarray, q: np.ndarray) -> list[int]:
    """Inner products of whole numbers, in 64 bits where they fit, else in Python's integers."""
    top = int(np.abs(vectors).max(initial=0)) * int(np.abs(q).max(initial=0)) * max(1, len(q))
    return (vectors @ q if top < 1 << 63 else vectors.astype(object) @ q.astype(object)).tolist()


class Tree:
    """An M-tree over the rows of ``whole`` (int64); distances are float64."""

    def __init__(self, ids: np.ndarray, whole: np.ndarray, m2: float):
        self.m2 = m2
        self.whole = whole
        vectors = whole.astype(np.float64)
        self.extra = np.sqrt(np.maximum(m2 - (vectors * vectors).sum(1), 0))
        self.vectors, self.ids, self.pages = vectors, ids, []
        groups = self._groups(np.arange(len(ids)), LEAF)
        level = []  # (routing object, its rows, page)
        for center, rows in groups:
            self.pages.append(("leaf", rows, self.between(rows, center)))
            level.append((center, rows, len(self.pages) - 1))
        while len(level) > 1:
            centers = np.array([c for c, _, _ in level])
            up = []
            for center, members in self._groups(centers, FANOUT, positions=True):
                kids = [level[i] for i in members]
                rows = np.concatenate([r for _, r, _ in kids])
                routing = np.array([c for c, _, _ in kids])
                radii = np.array([self.between(r, c).max() for c, r, _ in kids])
                self.pages.append(("node", routing, radii, self.between(routing, center), [p for _, _, p in kids]))
                up.append((center, rows, len(self.pages) - 1))
            level = up
        self.root = level[0][2] if level else None

    def between(self, rows: np.ndarray, center: int) -> np.ndarray:
        dot = self.vectors[rows] @ self.vectors[center] + self.extra[rows] * self.extra[center]
        return np.sqrt(np.maximum(2 * (self.m2 - dot), 0))

    def _groups(self, rows: np.ndarray, size: int, positions: bool = False):
        """Rows around evenly taken centers; groups above ``size`` are cut."""
        n = -(-len(rows) // size)
        at = np.unique(np.linspace(0, len(rows) - 1, n).astype(int))
        centers = rows[at]
        dot = self.vectors[rows] @ self.vectors[centers].T + np.outer(self.extra[rows], self.extra[centers])
        nearest = dot.argmax(1)
        out = []
        for j, c in enumerate(centers):
            members = np.flatnonzero(nearest == j)
            for i in range(0, len(members), size):
                part = members[i:i + size]
                out.append((c, part if positions else rows[part]))
        if len(out) == len(rows) and len(out) > 1:  # all alone (far apart): cut in order, so that levels shrink
            out = [(rows[i], np.arange(i, min(i + size, len(rows))) if positions else rows[i:i + size]) for i in range(0, len(rows), size)]
        return out

    def search(self, q: np.ndarray, own: int, k: int, bound: int | None = None) -> list[tuple[int, int]]:
        """The ``k`` best ``(score, id)`` among rows not ``own`` whose score is ``bound`` or more."""
        if self.root is None:
            return []
        f = q.astype(np.float64)
        length = float(f @ f)
        q2 = length + self.m2
        room = slack(length, self.m2)
        best: list[tuple[int, int]] = []  # (-score, id), sorted

        def least_score() -> int | None:
            return -best[-1][0] if len(best) == k and (bound is None or -best[-1][0] > bound) else bound

        def reach() -> float:
            low = least_score()
            return math.inf if low is None else math.sqrt(max(q2 - 2 * float(low), 0)) + room

        r = reach()
        heap = [(0.0, self.root, None)]
        while heap:
            least, page, parent = heapq.heappop(heap)
            if least > r:
                break
            p = self.pages[page]
            if p[0] == "node":
                _, routing, radii, up, kids = p
                left = np.arange(len(kids)) if parent is None else np.flatnonzero(np.abs(parent - up) - radii <= r + room)
                if len(left):
                    d = np.sqrt(np.maximum(q2 - 2 * (self.vectors[routing[left]] @ f), 0))
                    for i, x, low in zip(left.tolist(), d.tolist(), np.maximum(d - radii[left] - room, least).tolist(), strict=True):
                        if low <= r:
                            heapq.heappush(heap, (low, kids[i], x))
            else:
                _, rows, up = p
                if parent is not None:
                    rows = rows[np.abs(parent - up) <= r + room]
                low = least_score()
                if len(rows) and low is not None:  # rough scores first: exact ones for what may count
                    rough = self.vectors[rows] @ f
                    rows = rows[rough >= float(low) - room * room]
                if len(rows):
                    for i, score in zip(self.ids[rows].tolist(), exact_scores(self.whole[rows], q), strict=True):
                        x = (-score, i)
                        if i != own and (bound is None or score >= bound) and (len(best) < k or x < best[-1]):
                            best.append(x)
                            best.sort()
                            del best[k:]
                    r = reach()
        return [(-s, i) for s, i in best]


def _pack(v: np.ndarray) -> bytes:
    return np.ascontiguousarray(v, np.int64).tobytes()


def _unpack(blobs) -> np.ndarray:
    return np.stack([np.frombuffer(b, np.int64) for b in blobs])


def _home(pivots: dict[int, tuple[np.ndarray, np.ndarray]], m2: dict[int, float]):
    def home(batches):
        for pdf in batches:
            out = []
            for dim, part in pdf.groupby("dim"):
                x = np.array(part["v"].tolist(), np.int64)
                f = x.astype(np.float64)
                p, pe = pivots[int(dim)]
                extra = np.sqrt(np.maximum(m2[int(dim)] - (f * f).sum(1), 0))
                dot = f @ p.T + np.outer(extra, pe)
                cell = dot.argmax(1)
                dist = np.sqrt(np.maximum(2 * (m2[int(dim)] - dot[np.arange(len(f)), cell]), 0))
                ring = np.minimum(dist * (RINGS / (2 * math.sqrt(m2[int(dim)]) or 1)), RINGS - 1).astype(np.int32)
                out.append(pd.DataFrame({"vec_id": part["vec_id"].to_numpy(), "dim": int(dim), "cell": cell.astype(np.int32),
                                         "ring": ring, "dist": dist, "v": [_pack(r) for r in x]}))
            if out:
                yield pd.concat(out)

    return home


def _build(m2: dict[int, float]):
    def build(key, pdf):
        pdf = pdf.sort_values("vec_id")
        tree = Tree(pdf["vec_id"].to_numpy(np.int64), _unpack(pdf["v"]), m2[int(key[0])])
        return pd.DataFrame([[*map(int, key), pickle.dumps(tree.__dict__)]], columns=["dim", "cell", "block", "tree"])

    return build


def _search(k: int):
    def search(key, queries, trees):
        rows = []
        if len(queries) and len(trees):
            tree = Tree.__new__(Tree)
            tree.__dict__ = pickle.loads(trees["tree"].iloc[0])
            for qid, blob, low in zip(queries["query_id"], queries["v"], queries["low"], strict=True):
                q = np.frombuffer(blob, np.int64)
                rows += [(int(qid), i, s) for s, i in tree.search(q, int(qid), k, None if pd.isna(low) else int(low))]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype("int64")

    return search


def _route(cells: dict[int, list[tuple[int, np.ndarray, float]]], m2: dict[int, float]):
    def route(batches):
        for batch in batches:
            out = []
            cols = [batch.column(c).to_pylist() for c in ("query_id", "dim", "v", "low", "cell", "block")]
            for qid, dim, blob, low, cell0, block0 in zip(*cols, strict=True):
                q = np.frombuffer(blob, np.int64).astype(np.float64)
                length = float(q @ q)
                q2, room = length + m2[dim], slack(length, m2[dim])
                reach = math.inf if low is None else math.sqrt(max(q2 - 2 * float(low), 0)) + 3 * room
                for cell, pivot, radius in cells[dim]:
                    d = math.sqrt(max(q2 - 2 * float(pivot @ q), 0))
                    if d - radius <= reach:
                        out.append((qid, dim, cell, cell0, block0, d, reach, blob, low))
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], _ROUTED)

    return route


_ROUTED = ["query_id", "dim", "cell", "cell0", "block0", "d", "reach", "v", "low"]


def top_k(rows: DataFrame, queries: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = SCALE, block_rows: int = BLOCK_ROWS, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products of
    every row that ``queries`` (a condition on ``rows``) holds for, with all rows
    but those of its own id; ties go to the smaller id.

    Components count as floor(scale * x).  Vectors that are null, empty, or hold
    a null or non-finite component take no part, nor do rows without id; vectors
    meet only vectors of their own length.  Rows that repeat id and vector count
    once.  With fewer than ``k`` candidates all are returned.  An empty table or
    no query gives an empty result.  Other columns are not read.
    """
    spark = rows.sparkSession
    base = rows.select(col(id_col).cast("long").alias("vec_id"), quantized(col(vector_col), scale).alias("v"), F.coalesce(queries, F.lit(False)).alias("q"))
    base = base.where("vec_id is not null and v is not null").dropDuplicates(["vec_id", "v", "q"]).withColumn("dim", F.size("v"))
    base = written(base, "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    stats = {r["dim"]: r for r in base.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("m2")).collect()}
    if not stats:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    m2 = {d: float(r["m2"]) for d, r in stats.items()}
    want = {d: min(max_pivots, -(-r["n"] // block_rows)) for d, r in stats.items()}
    # pivots: rows of the smallest hashes, about as many as wanted
    scale_ = 1 << 40
    cut = F.lit(0)
    for d, r in stats.items():
        cut = F.when(F.col("dim") == d, min(scale_, int(scale_ * 2.0 * want[d] / r["n"]) + (scale_ if r["n"] <= 4 * want[d] + 32 else 0))).otherwise(cut)
    taken = base.where(F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(scale_)) < cut).select("dim", "vec_id", "v").orderBy("dim", F.xxhash64("vec_id", F.lit(7))).limit(4 * sum(want.values()) + 64 * len(want)).collect()
    pivots = {}
    for d in stats:
        mine = list(dict.fromkeys(tuple(r["v"]) for r in taken if r["dim"] == d))[:want[d]] or [(0,) * d]
        p = np.array(mine, np.float64)
        pivots[d] = (p, np.sqrt(np.maximum(m2[d] - (p * p).sum(1), 0)))
    dealt = written(base.select("vec_id", "dim", "v").mapInPandas(_home(pivots, m2), "vec_id long, dim int, cell int, ring int, dist double, v binary"), "cells")
    block = ["dim", "cell", "block"]
    # a cell's rows in the order of their distance, cut every block_rows; rows of one ring in the order of a hash
    rings = dealt.groupBy("dim", "cell", "ring").agg(F.count(F.lit(1)).alias("n"))
    inner = F.sum("n").over(Window.partitionBy("dim", "cell").orderBy("ring").rowsBetween(Window.unboundedPreceding, -1))
    rings = written(rings.withColumn("inner", F.coalesce(inner, F.lit(0))), "rings")
    at = F.col("inner") + F.pmod(F.xxhash64("vec_id"), F.col("n"))
    dealt = written(dealt.join(rings, ["dim", "cell", "ring"]).select("vec_id", "dim", "cell", F.floor(at / block_rows).alias("block"), "dist", "v"), "blocks")
    spans = written(dealt.groupBy(*block).agg(F.min("dist").alias("from"), F.max("dist").alias("to")), "spans")
    cells = {d: [] for d in stats}
    for r in spans.groupBy("dim", "cell").agg(F.max("to").alias("radius")).collect():  # at most max_pivots rows per length
        cells[r["dim"]].append((r["cell"], pivots[r["dim"]][0][r["cell"]], r["radius"]))
    trees = written(dealt.groupBy(*block).applyInPandas(_build(m2), "dim int, cell int, block long, tree binary"), "trees")
    asked = base.where("q").select(F.col("vec_id").alias("query_id")).distinct()
    own = dealt.join(asked, dealt["vec_id"] == asked["query_id"]).select("query_id", *block, "v")
    own = written(own.withColumn("low", F.lit(None).cast("long")), "queries")

    def meet(q: DataFrame) -> DataFrame:
        need = written(query_groups(q, block), "need")
        asking = q.join(need, block).withColumn("g", F.pmod(F.xxhash64("query_id"), F.col("groups")).cast("int")).select(*block, "g", "query_id", "v", "low")
        keys = [*block, "g"]
        return asking.groupBy(*keys).cogroup(tree_copies(trees, need, block).groupBy(*keys)).applyInPandas(_search(k), HITS)

    first = written(meet(own), "first")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    low = first.withColumn("rank", F.row_number().over(place)).where(F.col("rank") == k).select("query_id", F.col("score").alias("low"))
    known = own.drop("low").join(low, "query_id", "left").select("query_id", *block, "v", "low")
    schema = "query_id long, dim int, cell int, cell0 int, block0 long, d double, reach double, v binary, low long"
    routed = known.mapInArrow(_route(cells, m2), schema).join(spans, ["dim", "cell"])
    # the ring of a block, by the triangle inequality; not the query's own block again
    routed = routed.where((F.col("d") - F.col("to") <= F.col("reach")) & (F.col("from") - F.col("d") <= F.col("reach")))
    onward = written(routed.where((F.col("cell") != F.col("cell0")) | (F.col("block") != F.col("block0"))).select("query_id", *block, "v", "low"), "onward")
    found = first.unionByName(meet(onward)).distinct().withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def query_groups(queries: DataFrame, block: list[str], size: int = QUERY_GROUP) -> DataFrame:
    """How many groups the queries of each block make; blocks without any are not in it."""
    return queries.groupBy(*block).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("groups"))


def tree_copies(trees: DataFrame, need: DataFrame, block: list[str]) -> DataFrame:
    """A tree for each group of queries that asks for it."""
    return trees.join(need, block).select(*block, "tree", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("g"))


def op2_topk(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(rows, F.col("vec_id") % 50 == 0)


OP2_SQL = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""
