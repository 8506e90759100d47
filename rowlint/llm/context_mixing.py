"""Language-model scores by online logistic context mixing.

Symbols are the bytes of the lower-cased (A-Z) text: the 62 most frequent
training bytes, an escape for the others, and the end of the text.  After the
last three symbols the possible next ones are ranked, and a Huffman code of the
ranks turns a symbol into binary decisions (both from the counts of all training
texts).  Three predictors, each with a table hashed by the last 3, 4 or 6 symbols,
give a log-odds for every decision, from the counts of all training texts as
well.  Their log-odds are combined by weights that the depth of the decision
gates; the weights start from ones fitted on the decisions of all training texts
and go on learning inside each text, as does a last adaptive probability map that
corrects the mixed probability.  The fit needs each decision's log-odds only, so
tasks count decisions by them (in steps of ``1 << STEP_BITS`` units) and the driver fits on
these counts, whose number is fixed.  Updates come after
every ``BLOCK`` symbols of every text, so that many texts are worked on
side by side; a text's score depends on the model and that text alone.

The base score is a smoothed unigram score over words, with counts from all
training texts.  Words of the ``HEAVY`` most frequent (a fixed number) are
looked up from a broadcast table; the others are joined by hash, which leaves
no hot key in that join.

What is broadcast has a fixed size whatever the corpus: 3 * 2**22 table entries
of one byte, at most 2**24 ranks and ``HEAVY`` words.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import col, written

ORDERS = (3, 4, 6)
SLOT_BITS = 16
UNIT = 14.0  # log-odds are kept as whole numbers of 1 / UNIT
ESCAPE, END = 62, 63
LAST = 128
HEAVY = 1 << 16
CHUNK = 1 << 16  # table entries in a row while counts are gathered
FAN_IN = 64  # tables added up by one task at a time
FOURS = 1 << 24
STEP_BITS = 2  # log-odds are counted in steps of 4 units while weights and map are fitted
LEVEL_BITS = 8 - STEP_BITS
CELLS = 1 << (LEVEL_BITS * len(ORDERS))  # of one depth and outcome
NEWTON = 12
HELD_MOD = 10
PAD = 6
BLOCK = 32  # symbols of a text from one update to the next
SEGMENT = 1 << 21
GROUP = 1 << 18  # symbols worked on at once
SIDE = 1 << 16  # so many side by side while scoring, all their decisions at once
SORTED = 1 << 22  # so many sorted at once while counting
SCORED, SCORED_TEXTS = 1 << 24, 8192  # so many while scoring, which holds the contexts of one block at a time
BINS = 24
RATE = 0.3
APM_PRIOR = 48.0
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def lowered(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").translate(_LOWER)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_R = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        n = 1 << (n - 1).bit_length()
        for i, x in enumerate((_R, pow(_R, -1, 1 << 64))):
            p = np.full(n, x, np.uint64)
            p[0] = 1
            _POWERS[i] = np.cumprod(p, dtype=np.uint64)
    return _POWERS


def word_ids(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs between ASCII white space) of all texts, each
    text's one end among them, and the number of tokens of each text."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = _SPACE[raw]
    begin = np.flatnonzero(~space & np.r_[True, space[:-1]])
    end = np.flatnonzero(~space & np.r_[space[1:], True]) + 1
    h = np.empty(len(begin), np.uint64)
    i = 0
    while i < len(begin):  # some megabytes of words at a time
        j = max(i + 1, int(np.searchsorted(end, begin[i] + SEGMENT)))
        lo, hi = int(begin[i]), int(end[j - 1])
        up, down = _powers(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((raw[lo:hi].astype(np.uint64) + np.uint64(1)) * up[:hi - lo], out=sums[1:])
        h[i:j] = (sums[end[i:j] - lo] - sums[begin[i:j] - lo]) * down[begin[i:j] - lo]
        i = j
    h += (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    stop = np.cumsum([len(t) + 1 for t in texts])
    words = np.diff(np.r_[0, np.searchsorted(begin, stop)])
    at = np.cumsum(words)
    return np.insert(h.view(np.int64), at, 0x0E0D0E0D0E0D0E0D), words + 1  # the end is no word


@dataclass
class Code:
    """Symbols of bytes, their ranks after two symbols, and each rank's decisions."""

    symbol: np.ndarray  # of each byte
    escape_bits: np.ndarray  # cost of an escaped byte
    row: np.ndarray  # of each three symbols: their row of ranks
    rank: np.ndarray  # [row * 64 + symbol]
    step: np.ndarray  # [depth, rank]: node, 64 if what comes is the right side, LAST at a rank's last decision
    below: np.ndarray  # [2, rank, node]: ranks on either side of a node

    def paths(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The decisions of all ranks one after another: how many each rank has, where they begin,
        and of each decision its node, 64 if what comes is the right side, and 128 times its depth."""
        many = (self.step >= LAST).argmax(0) + 1
        begin = np.cumsum(many) - many
        depth = np.arange(many.sum()) - np.repeat(begin, many)
        step = self.step[depth, np.repeat(np.arange(64), many)]
        return many, begin, (step & 127) + 128 * depth


def symbols(byte_counts: np.ndarray) -> Code:
    """The symbols of bytes, a code without ranks yet."""
    order = np.lexsort((np.arange(256), -byte_counts))
    symbol = np.full(256, ESCAPE, np.uint8)
    symbol[order[:ESCAPE]] = np.arange(ESCAPE)
    rest = byte_counts[order[ESCAPE:]] + 1.0
    escape_bits = np.zeros(256)
    escape_bits[order[ESCAPE:]] = -np.log2(rest / rest.sum())
    return Code(symbol, escape_bits, *[np.zeros(0)] * 4)


def fours(texts: list[bytes], code: Code) -> Iterator[np.ndarray]:
    """Every symbol with the three before it, as one number below ``FOURS``."""
    for lo, hi in _groups(texts):
        s, first, _ = stream(texts[lo:hi], code)
        two = (s[:-1].astype(np.int32) << 6) | s[1:]
        yield ((two[:-2] << 12) | two[2:])[_mask(s, first)[3:]]


def make_code(byte_counts: np.ndarray, texts: list[bytes]) -> Code:
    code = symbols(byte_counts)
    keys = list(fours(texts, code))
    return ranked(code, *np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int32), return_counts=True))


def ranked(code: Code, key: np.ndarray, n: np.ndarray) -> Code:
    """The code with ranks and decisions, from how often each four symbols occur."""
    symbol, escape_bits = code.symbol, code.escape_bits
    # ranks: by count after three symbols, where they are frequent, then after two, then by count alone
    pairs = np.bincount(key & 0x3FFFF, n, 1 << 18).astype(float).reshape(-1, 64)
    alone = pairs.sum(0)
    seen, total = np.unique(key >> 6, return_inverse=True)
    mine = seen[np.bincount(total, n) >= 8] if len(seen) else seen
    row = np.tile(np.arange(4096, dtype=np.int64), 64)  # the last two of three symbols
    row[mine] = 4096 + np.arange(len(mine))
    share = pairs / np.maximum(pairs.sum(1, keepdims=True), 1) * 1e4
    rank = np.empty((4096 + len(mine), 64), np.uint8)

    def by_count(c: np.ndarray) -> np.ndarray:
        by = np.argsort(-(c + alone / max(1.0, alone.sum())), axis=1, kind="stable")
        out = np.empty(c.shape, np.uint8)
        np.put_along_axis(out, by, np.broadcast_to(np.arange(64, dtype=np.uint8), c.shape), 1)
        return out

    rank[:4096] = by_count(pairs * 1e4)
    own = row[key >> 6] >= 4096
    at, of, many = row[key[own] >> 6] - 4096, key[own] & 63, n[own]  # ascending, as the keys are
    for lo in range(0, len(mine), 8192):
        hi = min(lo + 8192, len(mine))
        a, b = np.searchsorted(at, [lo, hi])
        c = share[mine[lo:hi] & 4095]
        c[at[a:b] - lo, of[a:b]] += many[a:b] * 1e8
        rank[4096 + lo:4096 + hi] = by_count(c)
    freq = np.bincount(rank[row[key >> 6], key & 63], n, 64).astype(float)
    freq += 1 + freq.sum() / 8192  # bounds the depth of the code
    heap = [(f, i, i) for i, f in enumerate(freq)]
    heapq.heapify(heap)
    kids, n = {}, 64
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        kids[n] = (a[2], b[2])
        heapq.heappush(heap, (a[0] + b[0], n, n))
        n += 1
    paths: list[list[tuple[int, int]]] = [[] for _ in range(64)]
    todo: list[tuple[int, list]] = [(n - 1, [])]
    while todo:
        at, path = todo.pop()
        if at < 64:
            paths[at] = path
        else:
            todo += [(kids[at][0], [*path, (at - 64, 0)]), (kids[at][1], [*path, (at - 64, 1)])]
    depth = max(map(len, paths))
    step, below = np.zeros((depth, 64), np.uint8), np.zeros((2, 64, 64), np.float32)
    for s, path in enumerate(paths):
        for d, (x, y) in enumerate(path):
            step[d, s], below[y, s, x] = x + 64 * y + LAST * (d == len(path) - 1), 1
    return Code(symbol, escape_bits, row, rank.ravel(), step, below)


def _mask(s: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of every place, whether it is not padding."""
    real = np.ones(len(s), bool)
    for j in range(PAD):
        real[first - 1 - j] = False
    return real


def _real(s: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The places that are not padding."""
    return np.flatnonzero(_mask(s, first))


def stream(texts: list[bytes], code: Code) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts, each after ``PAD`` ends and followed by its own;
    first places and lengths."""
    sizes = np.array([len(t) + 1 for t in texts])
    pad = bytes([0]) * PAD
    raw = np.frombuffer(b"".join(pad + t + b"\0" for t in texts), np.uint8)
    s = code.symbol[raw]
    first = np.cumsum(sizes + PAD) - sizes
    for j in range(PAD):
        s[first - 1 - j] = END
    s[first + sizes - 1] = END
    return s, first, sizes


def sevens(s: np.ndarray) -> np.ndarray:
    """Every symbol from ``PAD`` on (along the last axis) with the six before it, as one number of 42 bits."""
    one = s.astype(np.uint64)
    two = one[..., 1:] | (one[..., :-1] << 6)
    four = two[..., 2:] | (two[..., :-2] << 12)
    six = four[..., 2:] | (two[..., :-4] << 24)
    return six[..., 1:] | (one[..., :-PAD] << 36)


def looked_up(key: np.ndarray, code: Code) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of numbers of seven symbols: the rank of the last, and for each order the
    first table entry of its context."""
    before = key >> 6
    row = code.row.take((before & 0x3FFFF).view(np.int64), mode="clip")
    rank = code.rank.take((row << 6) | (key & 63).view(np.int64), mode="clip")
    out = []
    for o in ORDERS:
        slot = ((before & ((1 << 6 * o) - 1)) * np.uint64(_R)) >> (64 - SLOT_BITS)
        out.append((slot << 6).view(np.int64))
    return rank, out


def contexts(s: np.ndarray, code: Code) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of every place from ``PAD`` on: the rank of its symbol, and for each order the first table entry of its context."""
    return looked_up(sevens(s), code)


def distinct(texts: list[bytes], code: Code) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The different numbers of seven symbols in some megabytes of texts at a time, and how often each occurs."""
    for lo, hi in _groups(texts, SORTED):
        s, first, sizes = stream(texts[lo:hi], code)
        real, keys = _mask(s, first)[PAD:], np.empty(sizes.sum(), np.uint64)
        n = 0
        for i in range(0, len(real), SIDE):
            own = sevens(s[i:i + SIDE + PAD])[real[i:i + SIDE]]
            keys[n:n + len(own)] = own
            n += len(own)
        keys.sort()
        new = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        begin = np.r_[0, new]
        times = np.diff(begin, append=len(keys)).astype(np.uint32)
        for i in range(0, len(begin), SIDE):
            yield keys[begin[i:i + SIDE]], times[i:i + SIDE]


def _groups(texts: list[bytes], most: int = GROUP):
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield lo, i
            lo, size = i, 0
        size += len(t) + PAD + 1
    if lo < len(texts):
        yield lo, len(texts)


@dataclass
class Model:
    code: Code
    tables: list[np.ndarray]  # log-odds by context and node, int8
    weights: np.ndarray  # [depth, predictor]: at the start of a text
    apm: np.ndarray  # [depth, bin, zeros and ones]: prior counts

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text."""
        out = np.zeros(len(texts))
        order = np.argsort([len(t) for t in texts], kind="stable")  # texts of like length side by side
        texts = [texts[i] for i in order]
        for lo, hi in _groups(texts, SCORED):
            out[order[lo:hi]] = self._group(texts[lo:hi])
        return out

    def _group(self, texts):
        """Bits of each of some texts, which come by length."""
        code = self.code
        s, first, sizes = stream(texts, code)
        wide = int(min(BLOCK, sizes.max()))
        # from every place on, a block with what comes before it; the last text has a whole block to read as well
        windows = sliding_window_view(np.r_[s, np.zeros(wide, np.uint8)], PAD + wide)
        k = len(texts)
        bits = np.zeros(k)
        esc = code.escape_bits
        rare = np.array([esc[np.frombuffer(t, np.uint8)].sum() if t else 0.0 for t in texts])
        weights = np.repeat(self.weights.T[:, None], k, 1).astype(np.float32)  # [predictor, text, depth]
        apm = np.repeat(self.apm[None], k, 0).astype(np.float32)  # [text, depth, bin, zeros and ones]
        paths, few = code.paths(), max(1, SIDE // BLOCK)
        for lo in range(0, int(sizes.max()), BLOCK):
            hi = lo + BLOCK
            who = np.flatnonzero(sizes > lo)
            # texts that end in this block have nothing left to learn for
            for part, learns in ((who[sizes[who] > hi], True), (who[sizes[who] <= hi], False)):
                for i in range(0, len(part), few):
                    self._block(part[i:i + few], learns, lo, hi, windows, first, sizes, weights, apm, bits, paths)
        return bits + rare

    def _block(self, who, learns, lo, hi, windows, first, sizes, weights, apm, bits, paths):
        """Bits of places ``lo`` to ``hi`` of the texts ``who``, which follow one another; learns from them if ``learns``."""
        k, m, deep, (many, begin, steps) = len(who), len(ORDERS), weights.shape[2], paths
        texts = slice(who[0], who[0] + k)
        count = np.minimum(sizes[texts], hi) - lo
        key = sevens(windows[first[texts] + (lo - PAD)])
        key = key[np.arange(key.shape[1]) < count[:, None]] if count.min() < key.shape[1] else key.ravel()
        rank, rows = looked_up(key, self.code)
        # all decisions side by side: the symbol of each, then its step
        n = many.take(rank, mode="clip")
        end = np.cumsum(n)
        symbol = np.repeat(np.arange(len(n)), n)
        step = (begin.take(rank, mode="clip") - (end - n)).take(symbol, mode="clip")
        step += np.arange(len(step))
        step = steps.take(step, mode="clip")
        node, side = step & 63, (step >> 6) & 1
        step >>= 7
        gate = np.repeat(np.arange(0, k * deep, deep), count).take(symbol, mode="clip")
        gate += step  # [text, depth]
        mine, x, odds = weights[:, texts].reshape(m, -1), None, []
        for t, r, w in zip(self.tables, rows, mine, strict=True):
            entry = r.take(symbol, mode="clip")
            entry += node
            odds.append(t.take(entry, mode="clip").astype(np.float32))  # in units
            part = w.take(gate, mode="clip")
            part *= odds[-1]
            x = part if x is None else np.add(x, part, out=x)
        p = np.exp(-x)
        p += 1
        np.reciprocal(p, out=p)
        x *= np.float32(BINS / 16)
        x += np.float32(BINS / 2)
        np.clip(x, 0, BINS - 1, out=x)
        # zeros and ones of the cells that are met, not of every text's whole map
        cell = gate * BINS
        cell += x.astype(np.intp)
        seen = apm[texts].reshape(-1)
        pair = seen.view(np.complex64).take(cell, mode="clip")
        f = pair.imag / (pair.imag + pair.real)
        f += p
        f *= np.float32(0.5)
        right = side.astype(np.float32)
        f -= 1 - right
        hit = np.abs(f, out=f)  # the probability that what came was given
        np.maximum(hit, np.float32(1e-6), out=hit)
        start = (end - n)[np.cumsum(count) - count]
        bits[texts] -= np.add.reduceat(np.log2(hit, out=hit), start, dtype=np.float64)
        if not learns:
            return
        # one gradient step a block, then the map's counts
        err = np.subtract(right, p, out=p)
        rate = RATE / UNIT ** 2 / (np.bincount(gate, minlength=k * deep) + 64.0)
        for w, o in zip(mine, odds, strict=True):
            w += rate * np.bincount(gate, np.multiply(err, o, out=o), k * deep)
        weights[:, texts] = mine.reshape(m, k, deep)
        cell *= 2
        cell += side
        np.add.at(seen, cell, np.float32(1))

    def decisions(self, texts: list[bytes], total: np.ndarray, levels: list[np.ndarray]) -> None:
        """Add to ``total`` [depth, outcome, cell] the decisions of ``texts`` by the levels of their log-odds."""
        code = self.code
        for key, n in distinct(texts, code):
            sym, rows = looked_up(key, code)
            for d in range(len(code.step)):
                if d:
                    live = np.flatnonzero(step < LAST)
                    if not len(live):
                        break
                    sym, n, rows = sym[live], n[live], [r[live] for r in rows]
                step = code.step[d].take(sym, mode="clip")
                node, cell = step & 63, ((step >> 6) & 1).astype(np.intp) + 2 * d
                for level, r in zip(levels, rows, strict=True):
                    cell <<= LEVEL_BITS
                    cell |= level.take(r + node, mode="clip")
                np.add.at(total, cell, n)

    def levels(self) -> list[np.ndarray]:
        return [((t.astype(np.int16) + 128) >> STEP_BITS).astype(np.uint8) for t in self.tables]

    def fit(self, decisions: np.ndarray) -> None:
        """Starting weights of most likelihood for counted decisions [depth, outcome, cell], then the map's counts by them."""
        for d, (zeros, ones) in enumerate(decisions.reshape(len(self.code.step), 2, CELLS)):
            met = np.flatnonzero(zeros + ones)
            x = np.stack([(met >> (LEVEL_BITS * i)) & ((1 << LEVEL_BITS) - 1) for i in reversed(range(len(ORDERS)))], 1)
            x = ((x << STEP_BITS) + ((1 << STEP_BITS) - 1) / 2 - 128).astype(float)  # units, at the middle of a step
            zero, one = zeros[met].astype(float), ones[met].astype(float)
            start = self.weights[d].astype(float)

            def cost(w, x=x, zero=zero, one=one, start=start):
                z = x @ w
                return (one * np.logaddexp(0, -z) + zero * np.logaddexp(0, z)).sum() + UNIT ** 2 / 2 * ((w - start) ** 2).sum()

            w, now = start, cost(start)
            for _ in range(NEWTON):
                p = 1 / (1 + np.exp(-(x @ w)))
                slope = x.T @ (p * (zero + one) - one) + UNIT ** 2 * (w - start)
                bend = (x * (p * (1 - p) * (zero + one))[:, None]).T @ x + UNIT ** 2 * np.eye(len(ORDERS))
                move = np.linalg.solve(bend, slope)
                while (new := cost(w - move)) > now and np.abs(move).max() > 1e-9:
                    move /= 2
                if new >= now:
                    break
                w, now = w - move, new
            self.weights[d] = w
            at = np.clip((x @ w) * (BINS / 16) + BINS / 2, 0, BINS - 1).astype(np.intp)
            self.apm[d, :, 0] += np.bincount(at, zero, BINS)
            self.apm[d, :, 1] += np.bincount(at, one, BINS)
        self.settle()

    def settle(self) -> None:
        """Give the map's prior a fixed weight per cell row."""
        total = self.apm.sum((1, 2), keepdims=True)
        self.apm = np.maximum(self.apm / total * APM_PRIOR * BINS, 0.02)


def tables_from(counts: list[np.ndarray], code: Code) -> list[np.ndarray]:
    """Log-odds of every node in every context, from symbol counts by context."""
    out = []
    prior = counts[0].reshape(-1, 64).sum(0).astype(np.float64) + 0.5
    p0 = (prior @ code.below[1]) / np.maximum(prior @ code.below[0] + prior @ code.below[1], 1e-9)
    for c in counts:
        table = np.empty(len(c), np.int8)
        rows = c.reshape(-1, 64)
        for i in range(0, len(rows), 8192):
            part = rows[i:i + 8192].astype(np.float32)
            one, zero = part @ code.below[1], part @ code.below[0]
            p = (one + 0.4 * p0) / (one + zero + 0.4)
            p = np.clip(p, 1.2e-4, 1 - 1.2e-4)
            table[i * 64:(i + len(part)) * 64] = np.rint(np.log(p / (1 - p)) * UNIT).astype(np.int8).ravel()
        out.append(table)
    return out


def _census(batches):
    """Word counts and byte counts of training texts, added up batch by batch."""
    for pdf in batches:
        hs, cs, bytes_, ends = [], [], np.zeros(256, np.int64), 0
        for data in _lowered(pdf["text"]):
            h, c = np.unique(word_ids(data)[0], return_counts=True)
            hs.append(h)
            cs.append(c)
            bytes_ += np.bincount(np.frombuffer(b"".join(data), np.uint8), minlength=256)
            ends += len(data)
        if ends:
            h, at = np.unique(np.concatenate(hs), return_inverse=True)
            c = np.bincount(at, np.concatenate(cs)).astype(np.int64)
            yield pd.DataFrame({"kind": np.r_[np.zeros(len(h)), np.ones(257)].astype(np.int32),
                                "h": np.r_[h, np.arange(257)], "c": np.r_[c, bytes_, ends]})


def _lowered(texts, most: int = 1 << 21) -> Iterator[list[bytes]]:
    """The texts as lowered bytes, a few megabytes at a time."""
    out, size = [], 0
    for t in texts:
        out.append(lowered(t))
        size += len(out[-1])
        if size > most:
            yield out
            out, size = [], 0
    if out:
        yield out


def _ngrams(code: Code):
    def ngrams(batches):
        total = [np.zeros(1 << (SLOT_BITS + 6), np.uint32) for _ in ORDERS]
        for pdf in batches:
            for texts in _lowered(pdf["text"], SORTED):
                for key, n in distinct(texts, code):
                    rank, base = looked_up(key, code)
                    for t, b in zip(total, base, strict=True):
                        np.add.at(t, b + rank, n)
        yield _counted(total)

    return ngrams


def _fours(code: Code):
    def counted(batches):
        total = np.zeros(FOURS, np.uint32)
        for pdf in batches:
            for texts in _lowered(pdf["text"]):
                for keys in fours(texts, code):
                    np.add.at(total, keys, np.uint32(1))
        yield _counted([total])

    return counted


def _decisions(shared):
    def counted(batches):
        model = shared.value
        levels, total = model.levels(), np.zeros(len(model.code.step) * 2 * CELLS, np.uint32)
        for pdf in batches:
            for texts in _lowered(pdf["text"], SORTED):
                model.decisions(texts, total, levels)
        yield _counted([total])

    return counted


def _counted(total: list[np.ndarray]) -> pd.DataFrame:
    """A task's counts, ``CHUNK`` entries a row."""
    rows = []
    part = TaskContext.get().partitionId()
    for o, t in enumerate(total):
        for i in range(0, len(t), CHUNK):
            if t[i:i + CHUNK].any():
                rows.append((o, i // CHUNK, part, zlib.compress(t[i:i + CHUNK].astype(np.int64).tobytes(), 1)))
    return pd.DataFrame(rows, columns=["o", "chunk", "part", "data"]).astype({"o": "int32", "chunk": "int32", "part": "int64"})


COUNTED = "o int, chunk int, part long, data binary"


def _summed(counts: DataFrame, name: str) -> Iterator[tuple[int, int, np.ndarray]]:
    """Counts of all tasks, ``FAN_IN`` of them added up by one task at a time."""
    parts = written(counts, name)
    most = parts.agg(F.coalesce(F.max("part"), F.lit(0)).alias("m")).first()["m"]
    while most > 0:
        parts = parts.withColumn("part", F.expr(f"part div {FAN_IN}")).groupBy("o", "chunk", "part").applyInPandas(_add, COUNTED)
        most //= FAN_IN
    for r in parts.toLocalIterator():  # at most 256 rows of CHUNK entries for each table, whatever the corpus
        yield r["o"], r["chunk"] * CHUNK, np.frombuffer(zlib.decompress(r["data"]), np.int64)


def _add(key, pdf):
    total = np.zeros(CHUNK, np.int64)
    for d in pdf["data"]:
        total += np.frombuffer(zlib.decompress(d), np.int64)
    return pd.DataFrame([[int(key[0]), int(key[1]), int(key[2]), zlib.compress(total.tobytes(), 1)]], columns=["o", "chunk", "part", "data"])


def train(rows: DataFrame) -> tuple[Model, DataFrame, int, int, np.ndarray, np.ndarray]:
    """Model, word counts ``(h, c)``, number of tokens, of distinct tokens, and the heavy words with counts.

    ``rows`` has ``id, text``; learns from all rows that are not held out.
    """
    train_rows = rows.where(~F.col("held"))
    census = written(train_rows.select("text").mapInPandas(_census, "kind int, h long, c long")
                     .groupBy("kind", "h").agg(F.sum("c").alias("c")), "census")
    counts = census.where("kind = 0").select("h", "c")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    by_byte = np.zeros(257, np.int64)
    for r in census.where("kind = 1").collect():  # 257 rows
        by_byte[r["h"]] = r["c"]
    top = counts.orderBy(F.desc("c"), "h").limit(HEAVY).toPandas().sort_values("h")
    code = symbols(by_byte[:256])
    keys, n_keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for _, at, c in _summed(train_rows.select("text").mapInPandas(_fours(code), COUNTED), "fours"):
        keys.append(at + np.flatnonzero(c))
        n_keys.append(c[c > 0])
    key, times = np.concatenate(keys), np.concatenate(n_keys)
    order = np.argsort(key)
    code = ranked(code, key[order], times[order])
    tables = [np.zeros(1 << (SLOT_BITS + 6), np.int64) for _ in ORDERS]
    for o, at, c in _summed(train_rows.select("text").mapInPandas(_ngrams(code), COUNTED), "ngrams"):
        tables[o][at:at + CHUNK] = c
    depth = len(code.step)
    model = Model(code, tables_from(tables, code), np.full((depth, len(ORDERS)), 0.35 / UNIT, np.float32), np.ones((depth, BINS, 2)))
    decisions = np.zeros(depth * 2 * CELLS, np.int64)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    for _, at, c in _summed(train_rows.select("text").mapInPandas(_decisions(shared), COUNTED), "decisions"):
        decisions[at:at + CHUNK] = c
    shared.unpersist()
    model.fit(decisions)
    return model, counts, int(total["n"]), int(total["v"]), top["h"].to_numpy(np.int64), top["c"].to_numpy(np.int64)


def _score(shared, n: int, v: int):
    def score(batches):
        model, heavy, heavy_c = shared.value
        heavy_log = np.log10((heavy_c + 0.1) / (n + 0.1 * (v + 1)))
        base, i = TaskContext.get().partitionId() << 33, 0
        for pdf in batches:
            for lo in range(0, len(pdf), SCORED_TEXTS):
                part = pdf.iloc[lo:lo + SCORED_TEXTS]
                data = [lowered(t) for t in part["text"]]
                bits = model.bits(data)
                out = []
                for few in range(0, len(data), 512):
                    ids, count = word_ids(data[few:few + 512])
                    for own in np.split(ids, np.cumsum(count)[:-1]):
                        h, c = np.unique(own, return_counts=True)
                        at = np.minimum(np.searchsorted(heavy, h), max(len(heavy) - 1, 0))
                        hit = heavy[at] == h if len(heavy) else np.zeros(len(h), bool)
                        known = c[hit]
                        logs = float((known * heavy_log[at[hit]]).sum())
                        out.append((int(c.sum()), int(known.sum()), logs, h[~hit], c[~hit].astype(np.int32)))
                yield pd.DataFrame({
                    "uid": np.arange(base + i, base + i + len(part)), "doc_id": part["id"].astype("Int64").to_numpy(), "held_out": part["held"].to_numpy(),
                    "n_bytes": np.array([len(t) for t in data], np.int64), "n_tokens": [o[0] for o in out], "n_known": [o[1] for o in out],
                    "base": [o[2] for o in out], "score": -bits * math.log10(2), "h": [o[3] for o in out], "tf": [o[4] for o in out]})
                i += len(part)

    return score


def with_lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score, bits_per_byte``.

    Learns from the rows whose crc32 of the id as text, modulo 10, is not 0.
    ``score`` is the model's log10 probability of the text with its end;
    ``bits_per_byte`` the same in bits, over its bytes (null for an empty text).

    Null texts count as empty: one token, the end.  Rows without id are training
    rows.  Without training rows nothing is known: counts are 0 and all symbols
    equally likely but for the code.  Repeated rows count and are scored each.
    An empty table gives an empty result.  Other columns are not read.
    """
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(col(id_col).cast("string").cast("binary")) % HELD_MOD == 0, F.lit(False))
    rows = docs.select(col(id_col).cast("long").alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"), held.alias("held"))
    model, counts, n, v, heavy, heavy_c = train(rows)
    shared = spark.sparkContext.broadcast((model, heavy, heavy_c))
    schema = "uid long, doc_id long, held_out boolean, n_bytes long, n_tokens long, n_known long, base double, score double, h array<long>, tf array<int>"
    scored = written(rows.mapInPandas(_score(shared, n, v), schema), "scored")
    rest = scored.select("uid", F.explode(F.arrays_zip("h", "tf")).alias("w")).select("uid", F.col("w.h").alias("h"), F.col("w.tf").alias("tf"))
    floor = n + 0.1 * (v + 1)
    found = rest.join(counts, "h", "left").groupBy("uid").agg(
        F.sum(F.col("tf") * F.log10((F.coalesce("c", F.lit(0)) + 0.1) / floor)).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("also"))
    out = scored.drop("h", "tf").join(found, "uid", "left")
    per_byte = F.when(F.col("n_bytes") > 0, -F.col("score") / math.log10(2) / F.col("n_bytes"))
    return out.select(
        F.col("doc_id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score", per_byte.alias("bits_per_byte"))


def op6_lm_score(spark, sf_dir):
    return with_lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
