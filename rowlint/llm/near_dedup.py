"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A document is the sequence of its five-word shingles (lower-cased words).
Each of ``BANDS`` Order MinHash sketches takes the ``ORDER`` smallest hashes of
occurrence-labelled shingles and keeps those shingles in text order, so equal
sketches speak for equal order and not just for equal sets.  Two documents of
similarity 0.8 share a given sketch of five shingles with probability 0.33, and
at least one of 36 with probability above 1 - 1e-6.

Similarity: ``L / (n + m - L)`` with ``L`` the longest common subsequence of
the two shingle sequences, n and m long; at 0.8 it can only come from places
within a band of (n + m) / 9 around the diagonal.

Groups are never expanded into pairs.  Exact copies (same words) are one
node.  In rounds, every bucket that still holds several components names
``LEADERS`` of its nodes, in each round others, and the nodes outside the bucket's
largest component are compared with leaders of other components: each with at
most ``FIRST`` and then ``PARTNERS`` a round, those first that it meets in most
buckets.  Links join nodes into components; a bucket takes part as long as the round
before added a link to one of its nodes, and the rounds end with the first that
adds none (or after ``ROUNDS``).  So their comparisons grow with the number of texts, however many
of them share a bucket.

The rounds only save work: a link can stay unseen in them.  After them every pair of
different components that shares a bucket is tested (``exhaustive``), in blocks of
bounded size, each pair in the first bucket that it shares.  A pair goes on to the
alignment unless the shingle counts alone, folded to ``BINS`` numbers a text, put it
below the threshold; that bound drops no link.  So the result is that of aligning
every pair that shares a bucket.  Texts of few shingles get
sketches of a lower order besides, since an edit changes a larger part of them.
Hot buckets and hot classes are dealt by (key, salt) and their leaders found by
a salted minimum.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import col, written

WORDS = 5
THRESHOLD = 0.8
ORDER = 5
BANDS = 36
SHORT = 40  # a text of at most so many shingles is sketched by these too
SHORT_ORDER, SHORT_BANDS = 2, 20
ROUNDS = 2
LEADERS = 3  # of a bucket, in a round
FIRST = 4  # partners of a node in the first round, where comparisons of near copies nearly all link
PARTNERS = 16  # of a node, in a later round
COMMON = 512  # places of an item in a text
BLOCK = 512  # nodes of a bucket that meet another block in one task, when all pairs are tested
BINS = 1024  # numbers that a text's shingle counts are folded to
SALTS = 64
SCAN = "uid long, doc_id long, sig binary, n int, fresh boolean, sk array<long>"
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(text: str) -> np.ndarray:
    ws = text.lower().split()
    return np.fromiter(map(xxhash.xxh64_intdigest, ws), _U, len(ws))


def shingles(h: np.ndarray, words: int = WORDS) -> np.ndarray:
    """A hash for every run of ``words`` words; one for a shorter text, none for an empty one."""
    n = len(h) - words + 1
    if n <= 0:
        return _mix(np.array([int((h * np.arange(3, 3 + 2 * len(h), 2, dtype=_U)).sum(dtype=_U))], _U)) if len(h) else h
    acc = np.zeros(n, _U)
    for j in range(words):
        acc = acc * _U(0x9E3779B97F4A7C15) + h[j:j + n]
    return _mix(acc)


def order_sketches(s: np.ndarray, bands: int = BANDS, order: int = ORDER) -> np.ndarray:
    """``bands`` hashes, each of the ``order`` smallest labelled shingles in text order."""
    n = len(s)
    at = np.argsort(s, kind="stable")
    run = s[at]
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    occ = np.empty(n, _U)
    occ[at] = (np.arange(n) - np.repeat(starts, np.diff(np.r_[starts, n]))).astype(_U)
    label = _mix(s + occ * _U(0xD6E8FEB86659FD93))
    odd = _mix(np.arange(1, bands + 1, dtype=_U)) | _U(1)
    if n <= order:
        first = np.tile(np.arange(n), (bands, 1))
    else:
        first = np.empty((bands, order), np.int64)
        step = max(1, (1 << 21) // n)  # bounded memory for very long texts
        for b in range(0, bands, step):
            v = _mix(label[None, :] ^ odd[b:b + step, None])  # the same order for texts of every length
            first[b:b + step] = np.argpartition(v, order - 1, axis=1)[:, :order]
        first.sort(axis=1)
    acc = odd.copy()
    for j in range(first.shape[1]):
        acc = _mix(acc * _U(0x9E3779B97F4A7C15) + s[first[:, j]])
    return acc.view(np.int64)


def sketches(s: np.ndarray, bands: int = BANDS, order: int = ORDER) -> np.ndarray:
    """All bucket keys of a text: of the order, and of the lower one for a short text."""
    out = order_sketches(s, bands, order)
    return np.r_[out, order_sketches(s, SHORT_BANDS, SHORT_ORDER) + 1] if len(s) <= SHORT else out


def similarity(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """The similarity of two shingle sequences if it reaches ``threshold``, else 0."""
    n, m = len(a), len(b)
    need = threshold * (n + m) / (1 + threshold)
    if not n or not m or min(n, m) < need - 1e-9:
        return 0.0
    k = min(n, m)
    diff = np.flatnonzero(a[:k] != b[:k])
    head = int(diff[0]) if len(diff) else k
    tail_max = k - head
    diff = np.flatnonzero(a[n - tail_max:][::-1] != b[m - tail_max:][::-1]) if tail_max else np.empty(0)
    tail = int(diff[0]) if len(diff) else tail_max
    x, y = a[head:n - tail], b[head:m - tail]
    common = head + tail
    if len(x) and len(y):
        # bound by shared values before any alignment
        u, cu = np.unique(x, return_counts=True)
        v, cv = np.unique(y, return_counts=True)
        _, i, j = np.intersect1d(u, v, assume_unique=True, return_indices=True)
        if common + np.minimum(cu[i], cv[j]).sum() < need - 1e-9:
            return 0.0
        common += _banded_lcs(x, y, int((n + m) * (1 - 2 * threshold / (1 + threshold))) + 1)
    return common / (n + m - common) if common >= need - 1e-9 else 0.0


def _banded_lcs(x: np.ndarray, y: np.ndarray, band: int) -> int:
    """Longest common subsequence by bit-parallel rows, places within ``band`` only.

    A row is the window of ``2 * band + 1`` places around the diagonal: it moves
    up one place with every item, and the place that leaves it is counted.  So
    memory is the texts and one window, not a row for every distinct item; only
    an item of more than ``COMMON`` places has a row of its own.
    """
    where: dict[int, list[int]] = {}
    for i, v in enumerate(x.tolist()):
        where.setdefault(v, []).append(i)
    rows = {v: _bits(places, len(x)) for v, places in where.items() if len(places) > COMMON}
    width = 2 * band + 1
    full = row = (1 << width) - 1
    low, gone = -band, 0  # the place of the lowest bit; common items below it
    for j, v in enumerate(y.tolist()):
        places = where.get(v)
        if places is None:
            continue
        lo, hi = j - band, j + band
        hit = 0
        if v in rows:
            hit = (rows[v] >> lo if lo > 0 else rows[v] << -lo) & full
        else:
            for i in places if len(places) == 1 else places[bisect_left(places, lo):bisect_right(places, hi)]:
                if lo <= i <= hi:
                    hit |= 1 << (i - lo)
        if not hit:
            continue
        step = lo - low  # the window moves only when something matches in it
        if step >= width:
            gone, row = gone + width - row.bit_count(), full
        elif step:
            gone += step - (row & ((1 << step) - 1)).bit_count()
            row = (row >> step) | (((1 << step) - 1) << (width - step))
        low = lo
        u = row & hit
        if u:
            row = ((row + u) | (row - u)) & full
    return gone + width - row.bit_count()


def _bits(places: list[int], n: int) -> int:
    flags = np.zeros(n, np.uint8)
    flags[places] = 1
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def _scan(bands, order, words):
    def scan(batches):
        base, i, seen = TaskContext.get().partitionId() << 33, 0, set()
        for pdf in batches:
            out = []
            for doc_id, text in zip(pdf["id"], pdf["text"], strict=True):
                h = word_hashes(text)
                sig = hashlib.md5(h.tobytes()).digest()
                fresh = sig not in seen
                n, sk = 0, None
                if fresh:
                    seen.add(sig)
                    s = shingles(h, words)
                    n, sk = len(s), sketches(s, bands, order) if len(s) else None
                out.append((base + i, None if doc_id is None or doc_id != doc_id else int(doc_id), sig, n, fresh, sk))
                i += 1
                if len(out) >= 500:
                    yield _frame(out)
                    out = []
            if out:
                yield _frame(out)

    return scan


def _frame(rows):
    return pd.DataFrame(rows, columns=["uid", "doc_id", "sig", "n", "fresh", "sk"]).astype({"doc_id": "Int64"})


def _sequences(words):
    def sequences(batches):
        seen = set()
        for pdf in batches:
            out = []
            for text in pdf["text"]:
                h = word_hashes(text)
                sig = hashlib.md5(h.tobytes()).digest()
                if len(h) and sig not in seen:
                    seen.add(sig)
                    out.append((sig, (shingles(h, words) >> _U(32)).astype(np.uint32).tobytes()))
            yield pd.DataFrame(out, columns=["sig", "seq"])

    return sequences


def _verify(threshold):
    def verify(batches):
        for pdf in batches:
            ok = [similarity(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32), threshold) > 0
                  for x, y in zip(pdf["xa"], pdf["xb"], strict=True)]
            yield pdf.loc[ok, ["a", "b"]]

    return verify


def _by_salt(rows: DataFrame, **aggs) -> DataFrame:
    """(k, s) with aggregates over all of k: combined per salt first, then over its salts."""
    part = rows.groupBy("k", "s").agg(*[f(c).alias(f"__{name}") for name, (f, c) in aggs.items()])
    over = Window.partitionBy("k")
    again = {F.count: F.sum}
    return part.select("k", "s", *[again.get(f, f)(f"__{name}").over(over).alias(name) for name, (f, _) in aggs.items()])


def components(edges: DataFrame, name: str) -> DataFrame:
    """``uid, label``: the smallest uid that a node of ``edges`` (a, b) reaches.

    Labels spread to neighbours and jump to their label's label, so the number
    of rounds grows with the logarithm of the longest chain; every round is
    written to the shared folder.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), f"{name}-edges")
    labels = written(both.groupBy(F.col("a").alias("uid")).agg(F.least(F.min("b"), F.min("a")).alias("label")), f"{name}-0")
    r = 0
    while True:
        r += 1
        near = both.join(labels.select(F.col("uid").alias("b"), "label"), "b").groupBy(F.col("a").alias("uid")).agg(F.min("label").alias("near"))
        step = labels.join(near, "uid").select("uid", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("uid").alias("next"), F.col("label").alias("up"))
        new = written(step.join(jump, "next").select("uid", F.col("label").alias("was"), F.least("next", "up").alias("label")), f"{name}-{r}")
        if new.where("label <> was").isEmpty():
            return new.select("uid", "label")
        labels = new.select("uid", "label")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    bands: int = BANDS, order: int = ORDER, words: int = WORDS, rounds: int = ROUNDS, partners: int = PARTNERS,
                    exhaustive: bool = True, salts: int = SALTS) -> DataFrame:
    """``doc_id, class_id`` for every row of ``docs``.

    ``class_id`` is the smallest id of the rows linked to this one, directly or
    through others, by equal words or by similarity of ``threshold`` or more.

    Null texts count as empty; texts without words equal each other and nothing
    else.  Texts shorter than a shingle are one shingle.  A null id keeps its
    row, cannot name a class, and has a null class only if no member has an
    id.  Rows that repeat an id are compared by their own text.  An empty table
    gives an empty result.  Other columns are not read.

    ``rounds`` and ``partners`` bound the comparisons of a text in the rounds; all
    others of texts that share a bucket and are not joined yet follow, unless
    ``exhaustive`` is off.
    """
    rows = docs.select(col(id_col).cast("long").alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    docs_text = rows.select("text")
    scan = written(rows.mapInPandas(_scan(bands, order, words), SCAN), "scan")
    # one node for each class of equal texts; scan keeps one row per class and task
    node = scan.where("fresh and sk is not null").groupBy("sig").agg(F.min("uid").alias("uid"))
    nodes = written(scan.select("uid", "sig", "n", "sk").join(node.select("uid"), "uid"), "nodes")
    in_buckets = nodes.select("uid", F.explode("sk").alias("k"))
    full = written(in_buckets.groupBy("k").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("k"), "full")
    shared = in_buckets.join(full, "k")  # a plain scan on the right: Spark can split a hot bucket
    salt = F.pmod(F.xxhash64("uid"), F.lit(salts)).cast("int").alias("s")
    buckets = written(shared.join(nodes.select("uid", "n"), "uid").select("uid", "n", salt, "k"), "buckets")
    # sequences are made again for the texts that share a bucket, one row per text
    busy = written(nodes.select("uid", "sig").join(buckets.select("uid").distinct(), "uid"), "busy")
    # merged whatever its size: the plan at scale, and none that changes with a broadcast threshold
    found = docs_text.mapInPandas(_sequences(words), "sig binary, seq binary").join(busy.hint("merge"), "sig")
    seqs = written(found.groupBy("uid").agg(F.first("seq").alias("seq")), "seqs")
    labels = written(buckets.select("uid").distinct().select("uid", F.col("uid").alias("label"), F.lit(1).cast("long").alias("size"), F.lit(True).alias("moved")), "labels")
    tested = edges = None
    for r in range(rounds):
        pairs = _starred(buckets.join(labels, "uid"), r, partners if r else min(FIRST, partners), threshold)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, f"pairs-{r}")
        links = written(_links(pairs, seqs, threshold), f"links-{r}")
        if links.isEmpty():
            break
        edges = links if edges is None else edges.union(links)
        tested = pairs if tested is None else tested.union(pairs)
        labels = _joined(labels, links, f"labels-{r}")
    labels = labels.select("uid", "label") if edges is None else _merged(labels, edges, "components")
    if exhaustive:
        pairs = written(_every(buckets, labels, nodes, seqs, threshold), "pairs-all")
        links = written(_links(pairs, seqs, threshold), "links-all")
        if not links.isEmpty():
            labels = _merged(labels, links, "components-all")
    # every row to its node by text, to its component, to the component's smallest id
    rows = scan.select("doc_id", F.col("sig").alias("k"), F.pmod("uid", F.lit(salts)).cast("int").alias("s"), "uid")
    # a class's node is its smallest uid: that row is always fresh
    here = rows.groupBy("k", "s").agg(F.min("doc_id").alias("lo"), F.min("uid").alias("any"))
    home = here.withColumn("node", F.min("any").over(Window.partitionBy("k"))).select("k", "s", "lo", "node")
    home = written(home.join(labels.select(F.col("uid").alias("node"), "label"), "node", "left").withColumn("label", F.coalesce("label", "node")), "home")
    first = written(home.groupBy("label").agg(F.min("lo").alias("class_id")), "first")  # a plain scan: Spark can split a hot label
    names = home.join(first, "label").select("k", "s", "class_id")
    return rows.join(names, ["k", "s"]).select(F.col("doc_id").alias(id_col), "class_id")


def _alike(x, y, threshold: float):
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    need = F.lit(threshold) * (x + y) / (1 + threshold)
    return F.least(x, y) >= need - 1e-9


def _joined(labels: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """Labels and component sizes after ``links``: every label hooks to the smallest
    that it is linked to, and to what that one hooks to.

    Between rounds that is enough: two labels of one component only cost comparisons
    that are not needed.  The components themselves are found once, from all links.
    """
    at = labels.select("uid", "label")
    ends = links.join(at.select(F.col("uid").alias("a"), F.col("label").alias("la")), "a").join(at.select(F.col("uid").alias("b"), F.col("label").alias("lb")), "b")
    both = ends.select(F.inline(F.array(F.struct(F.col("la").alias("label"), F.col("lb").alias("up")), F.struct(F.col("lb").alias("label"), F.col("la").alias("up")))))
    hooks = written(both.groupBy("label").agg(F.min("up").alias("up")).where("up < label"), f"{name}-hooks")
    twice = hooks.join(hooks.select(F.col("label").alias("up"), F.col("up").alias("far")), "up", "left").select("label", F.coalesce("far", "up").alias("up"))
    now = written(at.join(twice, "label", "left").select("uid", F.coalesce("up", "label").alias("label"), F.col("up").isNotNull().alias("moved")), f"{name}-now")
    sizes = now.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    return written(now.join(sizes, "label").select("uid", "label", "size", "moved"), f"{name}-sized")


def _merged(labels: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """Labels after ``links``, exactly: components of the labels that they join, each pair of labels once."""
    at = labels.select("uid", "label")
    ends = links.join(at.select(F.col("uid").alias("a"), F.col("label").alias("la")), "a").join(at.select(F.col("uid").alias("b"), F.col("label").alias("lb")), "b")
    pairs = ends.where("la <> lb").select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct()
    up = components(pairs, name).select(F.col("uid").alias("label"), F.col("label").alias("up"))
    return written(at.join(up, "label", "left").select("uid", F.coalesce("up", "label").alias("label")), f"{name}-merged")


def _starred(rows: DataFrame, r: int, partners: int, threshold: float) -> DataFrame:
    """Pairs of round ``r``: nodes outside their bucket's largest component with leaders of other components."""
    drawn = [F.struct(F.xxhash64("uid", "k", F.lit(r * LEADERS + i)), "uid", "label", "n") for i in range(LEADERS)]
    rows = rows.withColumns({f"o{i}": d for i, d in enumerate(drawn)}).withColumn("home", F.struct("size", "label"))
    found = _by_salt(rows, lo=(F.min, "label"), hi=(F.max, "label"), top=(F.max, "home"), moved=(F.max, "moved"), **{f"lead{i}": (F.min, f"o{i}") for i in range(LEADERS)})
    leads = F.array(*[F.struct(F.col(f"lead{i}.uid").alias("uid"), F.col(f"lead{i}.label").alias("label"), F.col(f"lead{i}.n").alias("n")) for i in range(LEADERS)])
    found = found.where("lo < hi and moved").select("k", "s", F.col("top.label").alias("top"), F.array_distinct(leads).alias("leads"))
    mine = rows.select("uid", "n", "k", "s", "label").join(found, ["k", "s"])
    if r:  # in the first round every node is its own component
        mine = mine.where("label <> top")
    others = F.transform(F.filter("leads", lambda x: (x["label"] != F.col("label")) & _alike(x["n"], F.col("n"), threshold)), lambda x: x["uid"])
    # a node in one row: its leaders, those first that it meets in most buckets
    met = mine.select("uid", others.alias("others")).where(F.size("others") > 0).groupBy("uid").agg(F.flatten(F.collect_list("others")).alias("met"))
    ranked = F.sort_array(F.transform(F.array_distinct("met"), lambda x: F.struct(-F.size(F.filter("met", lambda y: y == x)), F.xxhash64(x, F.col("uid")), x.alias("lead"))))
    pairs = met.select("uid", F.explode(F.slice(ranked, 1, partners)).alias("p")).select("uid", F.col("p.lead").alias("lead"))
    return pairs.select(F.least("uid", "lead").alias("a"), F.greatest("uid", "lead").alias("b")).distinct()


def _every(buckets: DataFrame, labels: DataFrame, nodes: DataFrame, seqs: DataFrame, threshold: float) -> DataFrame:
    """All pairs that share a bucket across two components, but those that their shingle counts rule out.

    Blocks of a bucket's nodes meet two by two; nodes of its largest component do not meet each other.
    """
    at = labels.groupBy("label").agg(F.count(F.lit(1)).alias("size")).join(labels, "label")
    rows = buckets.join(at, "uid").withColumn("home", F.struct("size", "label"))
    mixed = _by_salt(rows, c=(F.count, F.lit(1)), lo=(F.min, "label"), hi=(F.max, "label"), top=(F.max, "home")).where("lo < hi")
    rows = rows.join(mixed.select("k", "s", "c", F.col("top.label").alias("top")), ["k", "s"])
    rows = written(rows.select("uid", "n", "k", "s", "label", "c", (F.col("label") == F.col("top")).cast("long").alias("inside")), "mixed")
    inner, one = _by_salt(rows, inner=(F.sum, "inside")), F.col("c") <= BLOCK
    outer = F.when(one, 1).otherwise(F.ceil((F.col("c") - F.col("inner")) / BLOCK)).cast("int")  # blocks of nodes outside
    rows = rows.join(inner, ["k", "s"]).withColumns({"outer": outer, "of_top": F.when(one, 0).otherwise(F.ceil(F.col("inner") / BLOCK)).cast("int")})
    block = F.when(one, 0).when(F.col("inside") == 1, F.expr("outer + pmod(xxhash64(uid), greatest(of_top, 1))")).otherwise(F.expr("pmod(xxhash64(uid), outer)"))
    rows = rows.withColumn("g", block.cast("int"))
    counted = nodes.select("uid", "sk").join(seqs.mapInPandas(_folded, "uid long, bins binary"), "uid")
    rows = rows.select("uid", "n", "k", "label", "g", "outer", "of_top").join(counted, "uid")
    others = F.sequence(F.lit(0), F.when(F.col("g") >= F.col("outer"), F.col("outer")).otherwise(F.col("outer") + F.col("of_top")) - 1)
    rows = rows.select("uid", "n", "k", "label", "g", "sk", "bins", F.explode(others).alias("o"))
    rows = rows.select("k", F.least("g", "o").alias("i"), F.greatest("g", "o").alias("j"), "g", "uid", "n", "label", "sk", "bins")
    return rows.repartition("k", "i", "j").sortWithinPartitions("k", "i", "j").mapInPandas(_meet(threshold), "a long, b long")


def _folded(batches):
    """Shingle counts folded to ``BINS`` numbers: what they differ by is at most what the texts differ by."""
    for pdf in batches:
        bins = [np.minimum(np.bincount(np.frombuffer(x, np.uint32) % BINS, minlength=BINS), 255).astype(np.uint8).tobytes() for x in pdf["seq"]]
        yield pd.DataFrame({"uid": pdf["uid"], "bins": bins})


def _meet(threshold):
    def meet(batches):
        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            key = pdf[["k", "i", "j"]].to_numpy()
            ends = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            found = [_possible(pdf.iloc[lo:hi], threshold) for lo, hi in zip(np.r_[0, ends[:-1]], ends, strict=True)] if len(ends) else []
            rest = pdf.iloc[ends[-1]:] if len(ends) else pdf  # the last two blocks may go on: bounded rows
            if found:
                yield pd.concat(found)
        if rest is not None and len(rest):
            yield _possible(rest, threshold)

    return meet


def _possible(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Pairs of two blocks (or in one) of a bucket, in different components, first met here, that can reach the threshold."""
    share = (1 - threshold) / (1 + threshold)  # two texts may differ by this part of their shingles
    k, i, j = (rows[c].iat[0] for c in ("k", "i", "j"))
    uid, n, label, g = (rows[c].to_numpy() for c in ("uid", "n", "label", "g"))
    width = max(map(len, rows["sk"]))
    sk = np.repeat(~uid[:, None], width, 1)  # where a longer text has no sketch, equal to none
    for r, x in enumerate(rows["sk"]):
        sk[r, :len(x)] = x
    band = int(np.argmax((sk == k).all(0)))
    bins = np.frombuffer(b"".join(rows["bins"]), np.uint8).reshape(len(rows), -1)
    left, right = np.flatnonzero(g == i), np.flatnonzero(g == j)
    pairs = []
    for lo in range(0, len(left), 64):
        a = left[lo:lo + 64, None]
        ok = (label[a] != label[right]) & (np.abs(n[a] - n[right]) <= share * (n[a] + n[right]) + 1e-6)
        if i == j:
            ok &= a < right
        for b in range(band):  # met before
            ok &= sk[a, b] != sk[right, b]
        x, y = np.nonzero(ok)
        x, y = a[x, 0], right[y]
        for at in range(0, len(x), 1024):
            p, q = x[at:at + 1024], y[at:at + 1024]
            differ = (np.maximum(bins[p], bins[q]) - np.minimum(bins[p], bins[q])).sum(1, dtype=np.int64)
            can = differ <= share * (n[p] + n[q]) + 1e-6
            pairs.append((uid[p[can]], uid[q[can]]))
    a, b = (np.concatenate([p[z] for p in pairs] or [np.zeros(0, np.int64)]) for z in (0, 1))
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _links(pairs: DataFrame, seqs: DataFrame, threshold: float) -> DataFrame:
    # the larger side last: a leader of many pairs is a skewed join, which Spark splits
    joined = pairs.join(seqs.select(F.col("uid").alias("b"), F.col("seq").alias("xb")), "b").join(
        seqs.select(F.col("uid").alias("a"), F.col("seq").alias("xa")), "a")
    return joined.select("a", "b", "xa", "xb").mapInPandas(_verify(threshold), "a long, b long")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the near-duplicates: of each class the row with its smallest id.

    Rows without an id cannot be told apart and all stay, as do rows that
    repeat the smallest id.
    """
    classes = near_duplicates(docs, id_col, text_col, **options)
    kept = classes.where(F.col(id_col) == F.col("class_id")).select(F.col(id_col).alias("__kept")).distinct()
    whole = F.struct(*[col(c) for c in docs.columns]).alias("__row")
    rows = docs.select(whole, col(id_col).alias("__id"))
    found = rows.join(kept.hint("merge"), F.col("__id") == F.col("__kept"), "left_semi").unionAll(rows.where(F.col("__id").isNull()))
    return found.select("__row.*")


def op1_near_dedup(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
