"""Phrase collocations from FM-indexes over word ids, one per shard of the corpus.

Texts are cut into pieces at ``[.,;:!?`` and line breaks, pieces into words.  The
words of some million tokens are a shard, numbered by falling frequency;
per language and word the shards' counts are summed.  Words below the minimum
count are then breaks like a piece's end, since no phrase with one can reach it.

A shard's index holds its suffixes in the order of their first three symbols,
and its prefixes in the order of their last three, each with the Burrows-Wheeler
column of neighbouring symbols.  Phrases are enumerated by extending intervals:
every word to the left in the first index, its interval in the second kept in
step; every pair found to the right in the second.  One extension step does
all intervals of a level: in the stable order of the column, which is the LF
mapping, the rows of one interval and one symbol are a run, whose place is the
new interval and whose length is the count.  Counts are summed across shards.

Nothing is broadcast or held whole.  A phrase's counts meet in a bucket of
about ``BUCKET`` entries, chosen by its first word and, for words frequent enough
to fill buckets of their own, its second.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import col, written

MIN_COUNT = 10
TOP = 2000
CONTAINED = 50  # per cent
SHARD = 1 << 20  # tokens after which a shard is closed
BUCKET = 1 << 21
BLOCK = 4 << 20  # bytes of one text that are split into words at a time
LID_BITS = 22
SALTS = 16
SHARD_ROWS = "kind string, shard long, lid int, lang string, word string, c long, tokens binary, n long, carry int"
GRAMS = "a long, b long, c long, f long"
_CUTS = b"\t,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _CUTS, b"abcdefghijklmnopqrstuvwxyz " + b"." * (len(_CUTS) - 1))


def pack(x: np.ndarray) -> bytes:
    """Integers as compressed byte planes."""
    width = 4 if not len(x) or (x.max() < 1 << 31 and x.min() >= 0) else 8
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x, f"<i{width}").view(np.uint8).reshape(-1, width).T.tobytes())


def unpack(blob: bytes) -> np.ndarray:
    width = blob[0]
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(f"<i{width}").ravel().astype(np.int64)


class _Ids(dict):
    """Words of one language to the shard's numbers, 0 for a cut."""

    def __init__(self, lang, words):
        super().__init__({b".": 0})
        self.lang, self.words = lang, words

    def __missing__(self, word):
        i = self[word] = len(self.words)
        self.words.append((self.lang, word))
        return i


def _tokens(text: bytes):
    """The words and cuts of a text, some megabytes of it at a time."""
    data, at = text.translate(_PLAIN), 0
    while at < len(data):
        end = len(data)
        if at + BLOCK < end:
            end = min((i for i in (data.find(b" ", at + BLOCK), data.find(b".", at + BLOCK)) if i >= 0), default=end)
        yield data[at:end].replace(b".", b" . ").split()
        at = end


def _shards(limit: int, span: int):
    """Shard rows and their word rows.

    A text that goes on after its shard is closed leaves its last ``span`` words
    (back to the last cut) to the next shard as ``carry``, so that phrases across
    the border are counted there; what they count twice is taken off.
    """
    def shards(batches):
        base, no = TaskContext.get().partitionId() << 20, 0
        words, books, parts, size, carry = [None], {}, [], 0, 0

        def close():
            x = np.concatenate(parts).astype(np.int64)
            count = np.bincount(x, minlength=len(words))[1:]
            order = np.argsort(-count, kind="stable")
            lid = np.empty(len(words), np.int64)
            lid[0], lid[order + 1] = 0, np.arange(1, len(words))
            x = lid[x]
            count = count[order]
            if carry:
                np.subtract.at(count, x[:carry] - 1, 1)
            shard = base + no
            yield _table([("s", shard, None, None, None, None, pack(x), len(x), carry)])
            for i in range(0, len(order), 50_000):
                mine = order[i:i + 50_000] + 1
                yield pa.RecordBatch.from_arrays([
                    pa.array(["w"] * len(mine)), pa.array(np.full(len(mine), shard)), pa.array(np.arange(i + 1, i + 1 + len(mine), dtype=np.int32)),
                    pa.array([words[j][0] for j in mine], pa.string()), pa.array([words[j][1] for j in mine], pa.binary()).cast(pa.string()),
                    pa.array(count[i:i + 50_000].astype(np.int64)), pa.nulls(len(mine), pa.binary()), pa.nulls(len(mine), pa.int64()), pa.nulls(len(mine), pa.int32()),
                ], names)

        names = [f.split()[0] for f in SHARD_ROWS.split(", ")]
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                book = books.get(lang)
                if book is None:
                    book = books[lang] = _Ids(lang, words)
                for block in _tokens(text.as_buffer().to_pybytes()):
                    if size >= limit:
                        tail = parts[-1][-span:].tolist() if open_ else []
                        tail = tail[max((i + 1 for i, t in enumerate(tail) if not t), default=0):]
                        kept = [words[t] for t in tail]
                        yield from close()
                        no += 1
                        words, books, parts, size, carry = [None], {}, [], 0, len(kept)
                        book = books[lang] = _Ids(lang, words)
                        if kept:
                            parts.append(np.array([book[w] for _, w in kept], np.int32))
                            size = carry
                    open_ = True
                    ids = np.fromiter(map(book.__getitem__, block), np.int32, len(block))
                    # the words before a short block still belong to the tail
                    if len(ids) < span and parts:
                        parts[-1] = np.concatenate([parts[-1], ids])
                    else:
                        parts.append(ids)
                    size += len(ids)
                open_ = False
                if parts:
                    parts.append(np.zeros(1, np.int32))
                    size += 1
        if size:
            yield from close()

    def _table(rows):
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.int32()]
        names = [f.split()[0] for f in SHARD_ROWS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    return shards


class Index:
    """Both directions' indexes over ``x``, symbols 1 to ``size`` and 0 for breaks.

    ``x`` begins and ends with two breaks, so that no phrase crosses its ends.
    """

    def __init__(self, x: np.ndarray, size: int):
        self.n = len(x)
        self.counts = np.bincount(x, minlength=size + 1)
        self.first = np.r_[0, np.cumsum(self.counts)]
        after, before = np.roll(x, -1), np.roll(x, 1)
        self.left = self._column(self._order((x, after, np.roll(x, -2)), size), before)
        self.right = self._column(self._order((x, before, np.roll(x, 2)), size), after)

    @staticmethod
    def _order(keys, size: int) -> np.ndarray:
        if (size + 1) ** 3 < 1 << 63:
            return np.argsort((keys[0] * (size + 1) + keys[1]) * (size + 1) + keys[2])
        return np.lexsort(keys[::-1])

    @staticmethod
    def _column(order: np.ndarray, beside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        column = beside[order]
        lf = np.argsort(column, kind="stable")
        return column[lf], lf

    def extend(self, side, start: np.ndarray, length: np.ndarray):
        """All extensions by one symbol of disjoint, ordered intervals: for each
        the interval's number, the symbol, and the new interval's place and length."""
        symbol, lf = side
        owner = np.full(self.n, -1, np.int64)
        ends = np.cumsum(length)
        owner[np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)] = np.repeat(np.arange(len(start)), length)
        owner = owner[lf]
        at = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1])])
        count = np.diff(np.r_[at, self.n])
        keep = owner[at] >= 0
        at, count = at[keep], count[keep]
        return owner[at], symbol[at], at, count

    def pairs(self):
        """``first, second, place, count`` of every two-word phrase, by its interval in the right index."""
        w = np.arange(1, len(self.counts))
        parent, c, _, count = self.extend(self.left, self.first[w], self.counts[w])
        by = np.lexsort((c, parent))
        parent, c, count = parent[by], c[by], count[by]
        # in step: a word's interval on the right is divided by the symbol before it, breaks first
        before = np.cumsum(count) - count
        head = np.searchsorted(parent, parent)
        place = self.first[w][parent] + before - before[head]
        words = c > 0
        return c[words], w[parent[words]], place[words], count[words]

    def triples(self, place: np.ndarray, count: np.ndarray):
        """``pair, third, count`` of every right extension of the pairs."""
        parent, c, _, n = self.extend(self.right, place, count)
        words = c > 0
        return parent[words], c[words], n[words]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buckets(a: np.ndarray, b: np.ndarray, freq: np.ndarray, n_buckets: int, size: int) -> np.ndarray:
    """The bucket of each phrase by its first word; a first word of more than
    ``size`` occurrences is dealt to as many buckets as it could fill, by the second word."""
    ways = (1 + freq // size).astype(np.uint64)
    return (_mix(_mix(a) + _mix(b) % ways) % np.uint64(n_buckets)).astype(np.int64)


def _phrases(n_buckets: int, bucket: int):
    def phrases(key, shard, words):
        empty = pd.DataFrame({"bucket": pd.Series(dtype="int64"), "grams": pd.Series(dtype=object)})
        if not len(shard) or not len(words):
            return empty
        words = words.sort_values("lid")
        gid, freq = np.r_[0, words["gid"].to_numpy(np.int64)], np.r_[0, words["f"].to_numpy(np.int64)]
        x = unpack(shard["tokens"].iloc[0])
        to = np.zeros(max(int(x.max(initial=0)), int(words["lid"].max())) + 1, np.int64)
        to[words["lid"].to_numpy()] = np.arange(1, len(words) + 1)
        x = to[x]
        twice = x[:2] if shard["carry"].iloc[0] == 2 and (x[:2] > 0).all() else None
        x = np.r_[0, 0, x[(x > 0) | (np.r_[0, x[:-1]] > 0)], 0, 0]
        index = Index(x, len(words))
        a, b, place, count = index.pairs()
        pair, c, more = index.triples(place, count)
        if twice is not None:
            count = count - ((a == twice[0]) & (b == twice[1]))
        a, b, c, n = np.r_[a, a[pair]], np.r_[b, b[pair]], np.r_[np.zeros(len(a), np.int64), c], np.r_[count, more]
        home = buckets(gid[a], gid[b], freq[a], n_buckets, bucket)
        by = np.lexsort((c, b, a, home))
        a, b, c, n, home = gid[a[by]], gid[b[by]], gid[c[by]], n[by], home[by]
        if not len(home):
            return empty
        at = np.flatnonzero(np.r_[True, home[1:] != home[:-1]])
        rows = []
        for i, j in zip(at.tolist(), [*at[1:].tolist(), len(home)], strict=True):
            blobs = [pack(v[i:j]) for v in (a, b, c, n)]
            rows.append((int(home[i]), b"".join(len(x).to_bytes(4, "little") + x for x in blobs)))
        return pd.DataFrame(rows, columns=["bucket", "grams"])

    return phrases


def _columns(blob: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(blob):
        n = int.from_bytes(blob[at:at + 4], "little")
        out.append(unpack(blob[at + 4:at + 4 + n]))
        at += 4 + n
    return out


def _sums(min_count: int):
    def sums(pdf):
        a, b, c, n = (np.concatenate(v) for v in zip(*map(_columns, pdf["grams"]), strict=True))
        by = np.lexsort((c, b, a))
        a, b, c, n = a[by], b[by], c[by], n[by]
        at = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])])
        f = np.add.reduceat(n, at)
        keep = f >= min_count
        at = at[keep]
        return pd.DataFrame({"a": a[at], "b": b[at], "c": c[at], "f": f[keep]})

    return sums


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                  shard: int = SHARD, bucket: int = BUCKET) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables: ``gid, lang, word, f`` of every word of ``min_count`` or more
    occurrences; ``a, b, c, f`` of every phrase of two (c = 0) or three such words
    (by gid) that has as many; ``lang, n`` with the number of all words.

    Counts are exact over all texts.  Null texts are empty, null languages
    ``und``, rows that repeat count again, an empty table gives empty tables, and
    other columns are not read.  A text of any length is indexed in parts.
    """
    rows = docs.select(F.coalesce(col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.encode(F.coalesce(col(text_col).cast("string"), F.lit("")), "UTF-8").alias("text"))
    parts = written(rows.mapInArrow(_shards(shard, 2), SHARD_ROWS), f"shards-{uuid.uuid4().hex}")
    tokens = parts.where("kind = 's'").select("shard", "tokens", "n", "carry")
    words = parts.where("kind = 'w'").select("shard", "lid", "lang", "word", "c")
    one = Window.partitionBy("lang", "word")  # a word has one row per shard: no row count of its own to be hot
    own = F.shiftleft("shard", LID_BITS).bitwiseOR(F.col("lid").cast("long"))
    frequent = words.withColumn("own", own).withColumns({"f": F.sum("c").over(one), "gid": F.min("own").over(one)}).where(F.col("f") >= min_count)
    first = F.col("own") == F.col("gid")
    frequent = written(frequent.select("shard", "lid", "gid", "f", F.when(first, F.col("lang")).alias("lang"), F.when(first, F.col("word")).alias("word")), "frequent")
    total = tokens.agg(F.sum("n")).first()[0] or 0
    n_buckets = max(1, -(-2 * total // bucket))  # two phrases a token at most
    made = tokens.groupBy("shard").cogroup(frequent.select("shard", "lid", "gid", "f").groupBy("shard")).applyInPandas(_phrases(n_buckets, bucket), "bucket long, grams binary")
    grams = written(made.groupBy("bucket").applyInPandas(_sums(min_count), GRAMS), "grams")
    return frequent.where("lang is not null").select("gid", "lang", "word", "f"), grams, words.groupBy("lang").agg(F.sum("c").alias("n"))


_SCORE = "CAST(1000000 AS DECIMAL(38,0)) * CAST(a AS DECIMAL(38,0)) * CAST(a AS DECIMAL(38,0)) div (CAST({l} AS DECIMAL(38,0)) * CAST({r} AS DECIMAL(38,0)))"


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, contained: int = CONTAINED,
                 top: int = TOP, **sizes) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top``
    phrases of two or three words.

    a, l and r count the phrase and the two parts of its lowest-scoring cut (of
    equal scores the earlier cut), n all words; the score is
    floor(1000000 * a * a / (l * r)), exact in 38 digits.  A pair is left out if
    a triple with ``contained`` per cent of its occurrences or more holds it.
    Ties go to the larger a, then to the smaller phrase in bytes.  See
    :func:`phrase_counts` for nulls, repeats and empty tables.
    """
    words, grams, sizes_by_lang = phrase_counts(docs, text_col, lang_col, min_count, **sizes)
    pairs = grams.where("c = 0").select("a", "b", "f")
    triples = grams.where("c <> 0")

    def word(df: DataFrame, at: str) -> DataFrame:
        return df.join(words.select(F.col("gid").alias(at), F.col("word").alias(f"w_{at}"), F.col("f").alias(f"f_{at}"), F.col("lang").alias(f"lang_{at}")), at)

    holders = triples.select("a", "b", "f").unionAll(triples.select(F.col("b").alias("a"), F.col("c").alias("b"), "f")).groupBy("a", "b").agg(F.max("f").alias("longest"))
    free = pairs.join(holders, ["a", "b"], "left").where(F.col("longest").isNull() | (F.col("longest") * 100 < F.col("f") * contained))
    two = word(word(free, "a"), "b").select(F.col("lang_a").alias("lang"), F.concat_ws(" ", "w_a", "w_b").alias("phrase"), F.col("f").alias("count"),
                                            F.array(F.struct(F.lit(1).alias("k"), F.col("f_a").alias("l"), F.col("f_b").alias("r"))).alias("cuts"))
    head = pairs.select("a", "b", F.col("f").alias("f_ab"))
    tail = pairs.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("f").alias("f_bc"))
    three = word(word(word(triples, "a"), "b"), "c").join(head, ["a", "b"]).join(tail, ["b", "c"])
    three = three.select(F.col("lang_a").alias("lang"), F.concat_ws(" ", "w_a", "w_b", "w_c").alias("phrase"), F.col("f").alias("count"),
                         F.array(F.struct(F.lit(1).alias("k"), F.col("f_a").alias("l"), F.col("f_bc").alias("r")),
                                 F.struct(F.lit(2).alias("k"), F.col("f_ab").alias("l"), F.col("f_c").alias("r"))).alias("cuts"))
    both = two.unionAll(three).withColumnRenamed("count", "a")
    scored = both.select("lang", "phrase", "a", F.expr(f"array_min(transform(cuts, x -> struct({_SCORE.format(l='x.l', r='x.r')} AS score, x.k AS k, x.l AS l, x.r AS r)))").alias("cut"))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    rows = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt"))
    # first within a language's salts, so that no task gets more than SALTS times top rows, however many tasks there are
    near = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(sizes_by_lang, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark, sf_dir):
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))


OP12_SQL = r"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
u AS (SELECT lang, x AS w1, count(*) AS f FROM (SELECT lang, unnest(ws) AS x FROM w) GROUP BY ALL),
g2 AS (SELECT lang, x.a AS w1, x.b AS w2, count(*) AS f FROM (SELECT lang, unnest(list_transform(range(1, len(ws)), lambda j: {'a': ws[j], 'b': ws[j + 1]})) AS x FROM w)
  GROUP BY ALL HAVING count(*) >= 10),
g3 AS (SELECT lang, x.a AS w1, x.b AS w2, x.c AS w3, count(*) AS f
  FROM (SELECT lang, unnest(list_transform(range(1, len(ws) - 1), lambda j: {'a': ws[j], 'b': ws[j + 1], 'c': ws[j + 2]})) AS x FROM w) GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, sum(f) AS n FROM u GROUP BY lang),
cuts AS (
  SELECT g.lang, g.w1 || ' ' || g.w2 AS phrase, g.f AS a, 1 AS k, x.f AS l, y.f AS r FROM g2 g JOIN u x ON x.lang = g.lang AND x.w1 = g.w1 JOIN u y ON y.lang = g.lang AND y.w1 = g.w2
  WHERE NOT EXISTS (SELECT 1 FROM g3 t WHERE t.lang = g.lang AND t.w1 = g.w1 AND t.w2 = g.w2 AND 100 * t.f >= 50 * g.f)
    AND NOT EXISTS (SELECT 1 FROM g3 t WHERE t.lang = g.lang AND t.w2 = g.w1 AND t.w3 = g.w2 AND 100 * t.f >= 50 * g.f)
  UNION ALL SELECT g.lang, g.w1 || ' ' || g.w2 || ' ' || g.w3, g.f, 1, x.f, y.f FROM g3 g JOIN u x ON x.lang = g.lang AND x.w1 = g.w1
    JOIN g2 y ON y.lang = g.lang AND y.w1 = g.w2 AND y.w2 = g.w3
  UNION ALL SELECT g.lang, g.w1 || ' ' || g.w2 || ' ' || g.w3, g.f, 2, x.f, y.f FROM g3 g JOIN g2 x ON x.lang = g.lang AND x.w1 = g.w1 AND x.w2 = g.w2
    JOIN u y ON y.lang = g.lang AND y.w1 = g.w3),
s AS (SELECT *, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT o.lang, o.rank, o.phrase, o.a, o.l, o.r, CAST(n.n AS BIGINT) AS n, o.score FROM o JOIN n ON n.lang = o.lang WHERE o.rank <= 2000"""
