"""Toxicity: a subsequence-kernel SVM with Nystroem landmarks.

The kernel compares words by their common subsequences of three letters, each
gap letter costing a factor ``DECAY``, so insults with inserted letters stay
close to the plain ones.  White space is the only border between words; signs
inside a word are taken out first, and runs of single letters are one word, so
"i.d.i.o.t" and "i d i o t" read as one word.

Training.  Labels are of documents; a sentence inherits its document's label.
Words of clean sentences are negatives.  Which words of a toxic sentence are
to blame is not known: the first guess takes those whose subsequences are most
typical of toxic sentences, later rounds those that the SVM itself puts on the
toxic side.  The SVM (squared hinge) works on the Nystroem features of
``LANDMARKS`` landmark words.  A linear function of kernel values with fixed
landmarks is a weighted sum over subsequences, so a trained model is one table
of 64**3 weights, and scoring is table look-ups.

A document's score is the logistic of its strongest word and of its number of
words on the toxic side, fitted on the training documents.

Only a bounded sample of labelled documents is used for training
(``TOXIC_DOCS``, ``CLEAN_DOCS``, ``SENTENCES`` of each class): that sample is
all that reaches the driver.  Scoring covers every text in full.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from ._common import col

DECAY = 0.5
GAPS = ((0, 0), (1, 0), (0, 1), (1, 1), (2, 0), (0, 2))
LANDMARKS = 320
TOXIC_DOCS, CLEAN_DOCS, SENTENCES, SENTENCE_WORDS = 3000, 6000, 20000, 32
ROUNDS = 3
CUTOFF = 0.7
CHUNK = 1 << 20
SIZE = 64  # letter classes: 0 white space, 1-26 a-z, 27-36 digits, 37-61 other letters, 62 word border, 63 sign
_BORDER, _SIGN = 62, 63


def _classes() -> np.ndarray:
    t = np.full(0x110000, _SIGN, np.uint8)
    t[[9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x2028, 0x2029, 0x3000]] = 0
    t[ord("a"):ord("z") + 1] = np.arange(1, 27)
    t[ord("A"):ord("Z") + 1] = np.arange(1, 27)
    t[ord("0"):ord("9") + 1] = np.arange(27, 37)
    high = np.arange(0xC0, 0x110000)
    low = np.where((high < 0xDF) & (high != 0xD7), high + 32, high)  # Latin-1 capitals read as small letters
    t[high] = np.where((high >= 0x2000) & (high < 0x2C00), t[high], 37 + low % 25)
    return t


_TABLE: list[np.ndarray] = []


def _table() -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_classes())
    return _TABLE[0]


def word_stream(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter classes of all words, each between two borders, with the words'
    start places and the number of the text that each word is of."""
    joined = "\n".join(texts)
    c = _table()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    doc = np.repeat(np.arange(len(texts)), sizes + 1)[:len(c)]
    real = c != _SIGN
    c, doc = c[real], doc[real]
    space = c == 0
    # single letters in a row are one word: drop the space between two of them
    edge = np.flatnonzero(np.r_[True, space, True]) - 1  # places of spaces, with both ends
    lone = np.diff(edge) == 2
    both = lone[:-1] & lone[1:]
    inner = edge[1:-1]
    drop = inner[both]
    drop = drop[doc[drop - 1] == doc[np.minimum(drop + 1, len(doc) - 1)]] if len(drop) else drop
    if len(drop):
        keep = np.ones(len(c), bool)
        keep[drop] = False
        c, doc, space = c[keep], doc[keep], space[keep]
    letter = ~space
    begin = np.flatnonzero(letter & np.r_[True, space[:-1]])
    end = np.flatnonzero(letter & np.r_[space[1:], True]) + 1
    size = end - begin
    starts = np.r_[0, np.cumsum(size + 2)]
    out = np.full(starts[-1], _BORDER, np.uint8)
    at = np.flatnonzero(letter) + np.repeat(starts[:-1] + 1 - begin, size)
    out[at] = c[letter]
    return out, starts, doc[begin]


def subsequences(c: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each gap pattern: places, subsequence codes, weight."""
    left = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(c))
    wide = c.astype(np.int32)
    for g, h in GAPS:
        span = 2 + g + h
        at = np.flatnonzero(left > span)
        yield at, (wide[at] << 12) | (wide[at + 1 + g] << 6) | wide[at + span], DECAY ** (g + h)


def norms(starts: np.ndarray) -> np.ndarray:
    """Root of the number of subsequences, weighted as the kernel weights them."""
    n = np.diff(starts)
    total = np.zeros(len(n))
    for g, h in GAPS:
        total += np.maximum(n - 2 - g - h, 0) * DECAY ** (2 * (g + h))
    return np.sqrt(np.maximum(total, 1e-9))


@dataclass
class Model:
    """``weights``: one per subsequence; ``bias``; ``logistic``: of (1, strongest word, toxic words)."""

    weights: np.ndarray
    bias: float
    logistic: np.ndarray

    def margins(self, c: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The SVM's value of every word."""
        if len(starts) < 2:
            return np.empty(0)
        value = np.zeros(len(c), np.float32)
        for at, code, w in subsequences(c, starts):
            value[at] += np.float32(w) * self.weights[code]
        return np.add.reduceat(value, starts[:-1]) / norms(starts) + self.bias

    def features(self, texts: list[str]) -> np.ndarray:
        """Strongest word and log of one plus the number of toxic words, per text."""
        out = np.zeros((len(texts), 2), np.float32)
        out[:, 0] = -3.0  # a text without words
        for lo, hi in _chunks(texts):
            c, starts, doc = word_stream(texts[lo:hi])
            f = self.margins(c, starts)
            if len(f):
                first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
                out[lo + doc[first], 0] = np.clip(np.maximum.reduceat(f, first), -3, 3)
                out[lo + doc[first], 1] = np.log1p(np.add.reduceat((f > 0).astype(np.float64), first))
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.logistic[0] + x.astype(np.float64) @ self.logistic[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield lo, i
            lo, size = i, 0
        size += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)


def fit_words(words: list[str], toxic: np.ndarray, clean: np.ndarray, landmarks: int = LANDMARKS, rounds: int = ROUNDS) -> Model:
    """The SVM from words with the numbers of toxic and clean sentences that hold them."""
    model = Model(np.zeros(SIZE ** 3, np.float32), -1.0, np.array([0.0, 1.0, 0.0]))
    if not words or not toxic.any() or not clean.any():
        return model
    c, starts, of = word_stream(words)
    one = np.flatnonzero(np.bincount(of, minlength=len(words)) == 1)  # a word without letters has no stream
    slot = np.full(len(words), -1)
    slot[of] = np.arange(len(of))
    slot = slot[one]
    toxic, clean = toxic[one].astype(np.float32), clean[one].astype(np.float32)
    names = np.array(words, object)[one]
    owner = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))
    rank = np.full(len(starts) - 1, -1, np.int32)
    rank[slot] = np.arange(len(one))
    rows, codes, vals = [], [], []
    for at, code, w in subsequences(c, starts):
        rows.append(rank[owner[at]])
        codes.append(code)
        vals.append(np.full(len(at), w, np.float32))
    rows, codes, vals = np.concatenate(rows), np.concatenate(codes), np.concatenate(vals)
    del owner, at, code
    scale = norms(starts)[slot]
    # first guess: how much more often a word's subsequences occur in toxic sentences
    p = np.bincount(codes, vals * toxic[rows], SIZE ** 3)
    q = np.bincount(codes, vals * clean[rows], SIZE ** 3)
    ratio = np.log((p + 0.5) / (p.sum() + 1)) - np.log((q + 0.5) / (q.sum() + 1))
    mass = np.maximum(np.bincount(rows, vals, len(one)), 1e-9)
    guess = np.bincount(rows, vals * ratio[codes], len(one)) / mass
    del p, q
    guess -= 1.0 / np.sqrt(toxic + 1)  # rare words say little
    seen = np.sort(guess[clean > 0])
    limit = max(1.0, seen[int(0.999 * (len(seen) - 1))]) if len(seen) else 1.0
    pure = (clean == 0) & (toxic > 0)
    positive = pure & (guess > limit)
    # or in so many toxic and no clean sentences that it is no chance, whatever its letters
    share = min(0.99, max(0.01, toxic.sum() / max(1.0, toxic.sum() + clean.sum())))
    positive |= pure & (toxic >= math.log(0.05 / len(one)) / math.log(share))
    if not positive.any():
        if not pure.any():
            return model
        positive = pure & (guess >= guess[pure].max())
    order = np.lexsort((names, -guess))  # ties by the word, so a fit does not depend on row order
    margin = guess
    for _ in range(rounds):
        pos = order[positive[order]]
        neg = np.flatnonzero(clean > 0)
        hard = neg[np.lexsort((names[neg], -margin[neg]))][:3000]
        even = neg[np.lexsort((names[neg], -clean[neg]))][:3000]
        some = neg[np.argsort(np.array([hash_name(x) for x in names[neg]]), kind="stable")][:3000]
        neg = np.unique(np.r_[hard, even, some])
        pos = pos[np.lexsort((names[pos], -toxic[pos]))][:3000]
        marks = np.r_[pos[:landmarks // 2], hard[:landmarks // 4], some[:landmarks // 4]]
        beta, bias = _svm(rows, codes, vals, scale, pos, neg, np.unique(marks), np.sqrt(toxic[pos]))
        model = Model(beta.astype(np.float32), bias, model.logistic)
        f = np.bincount(rows, vals * beta[codes], len(one)) / scale + bias
        margin = f
        better = pure & (f > 0)
        if better.any():
            positive = better
    return model


def hash_name(s: str) -> int:
    import zlib

    return zlib.crc32(s.encode("utf-8", "surrogatepass"))


def _svm(rows, codes, vals, scale, pos, neg, marks, weight):
    """Squared-hinge SVM in the space of the landmarks; weights per subsequence."""
    used = np.unique(codes[np.isin(rows, marks)])
    column = np.full(SIZE ** 3, -1)
    column[used] = np.arange(len(used))

    def phi(ids):
        dense = np.zeros((len(ids), len(used)), np.float32)
        at = np.full(len(scale), -1)
        at[ids] = np.arange(len(ids))
        mine = (at[rows] >= 0) & (column[codes] >= 0)
        np.add.at(dense, (at[rows[mine]], column[codes[mine]]), vals[mine])
        dense /= scale[ids][:, None].astype(np.float32)
        return dense

    z = phi(marks)
    k = (z @ z.T).astype(np.float64)
    val, vec = np.linalg.eigh(k + 1e-6 * np.eye(len(k)))
    ok = val > 1e-5
    root = vec[:, ok] / np.sqrt(val[ok])
    ids = np.r_[pos, neg]
    onto = (z.T @ root.astype(np.float32)).astype(np.float32)
    x = np.concatenate([phi(ids[i:i + 250]) @ onto for i in range(0, len(ids), 250)]).astype(np.float64)
    x = np.c_[x, np.ones(len(x))]
    y = np.r_[np.ones(len(pos)), -np.ones(len(neg))]
    cost = np.r_[weight / weight.sum(), np.full(len(neg), 2.0 / len(neg))] * 200
    w = np.zeros(x.shape[1])
    reg = np.r_[np.full(x.shape[1] - 1, 0.05), 1e-6]
    for _ in range(25):  # Newton steps on the rows inside the margin
        inside = y * (x @ w) < 1
        xa = x[inside] * cost[inside, None]
        new = np.linalg.solve(xa.T @ x[inside] + np.diag(reg), xa.T @ y[inside])
        done = np.abs(new - w).max() < 1e-6
        w = new
        if done:
            break
    beta = np.zeros(SIZE ** 3)
    beta[used] = z.T @ (root @ w[:-1])
    return beta, float(w[-1])


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps.

    A stronger word or more toxic words never lower the score: if a slope comes
    out negative (few rows), only the strongest word is used."""
    x1 = np.c_[np.ones(len(x)), x.astype(float)]
    for reg in (np.array([1e-3, 0.02, 0.02]), np.array([1e-3, 0.02, 1e9])):
        b = np.zeros(x1.shape[1])
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(x1 @ b, -30, 30)))
            h = (x1 * (weight * p * (1 - p))[:, None]).T @ x1 + np.diag(reg)
            step = np.linalg.solve(h, x1.T @ (weight * (y - p)) - reg * b)
            b = b + np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        if (b[1:] >= 0).all():
            break
    return np.r_[b[0], np.maximum(b[1:], 0)]


def _scorer(model: Model):
    @F.pandas_udf(ArrayType(FloatType()))
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(list(model.features(s.tolist())), index=s.index, dtype=object)

    return features


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          toxic_docs: int = TOXIC_DOCS, clean_docs: int = CLEAN_DOCS, sentences: int = SENTENCES) -> Model:
    """A model from ``labels`` (``id_col``, ``label_col`` 0/1) and their documents.

    Held out: ids whose crc32 as text, modulo 3, is 1.  Null ids, labels other
    than 0 and 1 and unlabelled documents take no part; an id with several
    labels is toxic if one of them is.  Without labels of both classes the model
    scores every text the same, as clean.  The sample is taken by hashes of ids,
    so it is the same for the same rows in any order.
    """
    held = F.crc32(F.col("d").cast("string").cast("binary")) % 3 == 1
    known = (labels.select(col(id_col).alias("d"), col(label_col).alias("y")).where("d is not null and y in (0, 1)")
             .where(~held).groupBy("d").agg(F.max("y").cast("int").alias("y")))
    n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return Model(np.zeros(SIZE ** 3, np.float32), -1.0, np.array([-3.0, 1.0, 0.0]))
    scale = 1 << 30

    def cut(limit: int, total: int) -> int:
        return scale if total <= limit else int(scale * (limit / total))

    keep = F.when(F.col("y") == 1, cut(toxic_docs, n[1])).otherwise(cut(clean_docs, n[0]))
    picked = known.where(F.pmod(F.xxhash64("d"), F.lit(scale)) < keep)  # about toxic_docs + clean_docs rows, whatever the input
    sample = docs.select(col(id_col).alias("d"), F.coalesce(col(text_col), F.lit("")).alias("x")).join(F.broadcast(picked), "d")
    pieces = sample.select("d", "y", F.posexplode(F.split("x", r"[.!?\n]")).alias("i", "s"))
    pieces = pieces.select("d", "y", "i", F.filter(F.split("s", r"\s+"), lambda w: w != "").alias("w")).where(F.size("w") > 0)
    parts = F.transform(F.sequence(F.lit(0), F.expr(f"(size(w) - 1) div {SENTENCE_WORDS}")), lambda j: F.slice("w", j * SENTENCE_WORDS + 1, F.lit(SENTENCE_WORDS)))
    pieces = pieces.select("d", "y", "i", F.posexplode(parts).alias("j", "w"))
    m = {r["y"]: r["n"] for r in pieces.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(m) == 2:
        take = F.when(F.col("y") == 1, cut(sentences, m[1])).otherwise(cut(sentences, m[0]))
        pieces = pieces.where(F.pmod(F.xxhash64("d", "i", "j"), F.lit(scale)) < take)
    counts = (pieces.select("y", F.explode(F.array_distinct("w")).alias("w")).groupBy(F.lower(F.substring("w", 1, 64)).alias("w"))
              .agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("q")).toArrow().to_pandas().sort_values("w"))
    model = fit_words(counts["w"].tolist(), counts["p"].to_numpy(), counts["q"].to_numpy())
    got = sample.select("y", _scorer(model)("x").alias("f")).toPandas()
    if got["y"].nunique() < 2:
        return model
    x, y = np.array(got["f"].tolist(), float), got["y"].to_numpy(float)
    share = np.where(y == 1, n[1] / max(1, y.sum()), n[0] / max(1, (1 - y).sum()))
    model.logistic = fit_logistic(x, y, share * len(y) / share.sum())
    return model


def with_scores(docs: DataFrame, model: Model, out: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with the score (0 to 1) of every whole text in column ``out``.

    Null and empty texts get the score of a text without words.  All rows and
    columns stay; a column named ``out`` is replaced.
    """
    b0, b1, b2 = (float(v) for v in model.logistic)
    f = _scorer(model)(F.coalesce(col(text_col), F.lit("")))
    score = 1 / (1 + F.exp(-(F.lit(b0) + b1 * F.get(f, F.lit(0)).cast("double") + b2 * F.get(f, F.lit(1)).cast("double"))))
    return docs.withColumn(out, score)


def drop_toxic(docs: DataFrame, labels: DataFrame, cutoff: float = CUTOFF, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score ``cutoff`` or more, trained on ``labels``."""
    model = train(docs, labels, id_col, text_col)
    name = "score"
    while name in docs.columns:
        name += "_"
    return with_scores(docs, model, name, text_col).where(F.col(name) < cutoff).drop(name)


def op5_toxicity(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1
    return with_scores(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted"))
