"""Benchmark decontamination by pigeonhole edit matching.

A test item of length n may occur in a document with up to ``k = rate * n``
edits.  Cut into k + 1 pieces, at least one piece of it then occurs unchanged.
All pieces of a block of items go into one Aho-Corasick automaton; every hit
fixes where the item would have to lie, and only that window is verified, by
Myers' bit-parallel edit distance.

Texts and items are compared lower-cased and with single spaces.  Documents
are never shuffled: a block of items of bounded size (``BLOCK_CHARS``) travels
to the tasks, and a larger set of items is taken block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from ._common import col, written

RATE = 0.08
BLOCK_CHARS = 4_000_000
HITS = ArrayType(StructType([StructField("item_id", LongType()), StructField("distance", IntegerType()),
                             StructField("start", IntegerType()), StructField("end", IntegerType())]))


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """``k + 1`` pieces that cover the item, with their places."""
    n = len(item)
    cuts = [n * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def budget(n: int, rate: float) -> int:
    """Edits allowed for an item of n characters; every piece keeps a character."""
    return max(0, min(int(rate * n), n - 1))


def myers(item: str, text: str, peq: dict[str, int]) -> tuple[int, int]:
    """Smallest edit distance of ``item`` to a part of ``text`` and that part's first end."""
    m = len(item)
    mask, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = mask, 0, m
    best, end = m, 0
    for j, c in enumerate(text, start=1):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & mask)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & mask, (mh << 1) & mask
        pv, mv = mh | (~(xv | ph) & mask), ph & xv
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    """All matches of a block of items in a text."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items, self.auto, where = [], ahocorasick.Automaton(), {}
        for item_id, raw in items:
            text = normal(raw or "")
            if not text or item_id is None:
                continue
            k = budget(len(text), rate)
            masks: dict[str, int] = {}
            for i, c in enumerate(text):
                masks[c] = masks.get(c, 0) | (1 << i)
            back: dict[str, int] = {}
            for i, c in enumerate(reversed(text)):
                back[c] = back.get(c, 0) | (1 << i)
            self.items.append((item_id, text, k, masks, back))
            for at, p in pieces(text, k):
                where.setdefault(p, []).append((len(self.items) - 1, at))
        for p, places in where.items():
            self.auto.add_word(p, (len(p), places))
        if where:
            self.auto.make_automaton()
        self.empty = not where

    def find(self, raw: str) -> list[tuple[int, int, int, int]]:
        """``(item_id, distance, start, end)`` of each item's best match, by item."""
        if self.empty:
            return []
        text = normal(raw)
        spans: dict[int, list[list[int]]] = {}
        for e, (size, places) in self.auto.iter(text):
            for i, at in places:
                start, (_, item, k, _, _) = e - size + 1 - at, self.items[i]
                lo, hi = max(0, start - k), min(len(text), start + len(item) + k)
                own = spans.setdefault(i, [])
                if own and lo <= own[-1][1]:  # hits come by their ends: windows of an item nearly in order
                    own[-1][0], own[-1][1] = min(own[-1][0], lo), max(own[-1][1], hi)
                else:
                    own.append([lo, hi])
        out = []
        for i, windows in spans.items():
            item_id, item, k, masks, back = self.items[i]
            best = None
            for lo, hi in windows:
                at = text.find(item, lo, hi)
                if at >= 0:
                    best = (0, at, at + len(item))
                    break
                if not k or hi - lo < len(item) - k:
                    continue
                d, end = myers(item, text[lo:hi], masks)
                if d <= k and (best is None or d < best[0]):
                    # the start: the same distance, read backwards from the end
                    reach = text[max(lo, lo + end - len(item) - k):lo + end][::-1]
                    best = (d, lo + end - self._start(item, reach, back, d), lo + end)
            if best:
                out.append((item_id, *best))
        return sorted(out)

    @staticmethod
    def _start(item, reach, back, d):
        m = len(item)
        mask, top = (1 << m) - 1, 1 << (m - 1)
        pv, mv, score = mask, 0, m
        for j, c in enumerate(reach, start=1):
            eq = back.get(c, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | (~(xh | pv) & mask)
            mh = pv & xh
            score += bool(ph & top) - bool(mh & top)
            ph, mh = ((ph << 1) | 1) & mask, (mh << 1) & mask  # anchored: the first row counts up
            pv, mv = mh | (~(xv | ph) & mask), ph & xv
            if score <= d:
                return j
        return len(reach)


def _matches(items: list[tuple[int, str]], rate: float, text: Column) -> Column:
    @F.pandas_udf(HITS)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = Matcher(items, rate)
        for s in batches:
            yield pd.Series([[dict(zip(("item_id", "distance", "start", "end"), h, strict=True)) for h in m.find(t)] for t in s], index=s.index, dtype=object)

    return find(text)


def numbered(items: DataFrame, id_col: str, text_col: str, block_chars: int) -> tuple[DataFrame, int]:
    """The distinct items in the shared folder, each with the number of its block, and how many blocks there are."""
    rows = written(items.select(col(id_col).cast("long").alias("i"), col(text_col).alias("t")).where("i is not null and t is not null").distinct(), "items")
    size = rows.agg(F.sum(F.char_length("t")).alias("s")).first()["s"] or 0
    n = 1 if size <= block_chars else -(-2 * size // block_chars)
    return rows.withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(n))), n


def with_matches(docs: DataFrame, items: DataFrame, out: str = "matches", rate: float = RATE, text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with the benchmark items found in each text, in column ``out``.

    One entry ``(item_id, distance, start, end)`` for every item that lies in
    the text with at most ``rate`` edits per character: its smallest distance
    and the code points of its first such place in the lower-cased text with
    single spaces.

    Null and empty texts have no entry.  Items that are null, empty or without
    id match nothing; items that repeat an id are each looked for, and each
    found one is an entry.  No items: no entries.  All rows and other columns
    stay; a column named ``out`` is replaced.

    The items lie in the shared folder in blocks of about ``block_chars`` characters.
    Each block is a pass of its own over the texts, written before the next: no
    plan, worker or moment on the driver holds more than one.
    """
    rows, n = numbered(items, item_id_col, item_text_col, block_chars)
    found = "found"
    while found in docs.columns or found == out:
        found += "_"
    done = docs.withColumn(found, F.array().cast(HITS))
    for b in range(n):
        block = sorted((r["i"], r["t"]) for r in rows.where(F.col("b") == b).select("i", "t").collect())
        done = done.withColumn(found, F.concat(found, _matches(block, rate, F.coalesce(col(text_col), F.lit("")))))
        if b < n - 1:
            done = written(done, f"pass-{b}")
    return done.withColumn(out, F.array_sort(found)).drop(found)


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item, with or without an id."""
    name = "matches"
    while name in docs.columns:
        name += "_"
    text = options.pop("item_text_col", "text")
    options.pop("item_id_col", None)
    named = items.select(F.xxhash64(col(text)).alias("i"), col(text).alias("t")).where("t is not null")
    return with_matches(docs, named, name, item_id_col="i", item_text_col="t", **options).where(F.size(name) == 0).drop(name)


def op7_decontamination(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = with_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", (F.size("matches") > 0).alias("contaminated"), F.col("matches.item_id").alias("item_ids"),
                        F.col("matches.distance").alias("distances"), F.array_min("matches.distance").alias("least_distance"))
