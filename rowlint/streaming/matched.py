"""Events judged by other events of their key: followed in time, or repeated too soon.

Each function takes a batch or a stream and gives the same verdicts on both.

Batch: the time axis is cut into stretches as long as the interval, so an event
and what decides it lie in one stretch or in neighbours.  One row of a stretch
(the first of the deciding events, or the last) stands in the neighbour as well.
A group is thus one key in one stretch, not all of a key, and the work is
linear: no pairs are made.

Stream: a stream-stream join with a watermark on both sides (followed), or
keyed state that expires (repeated).  State is held for as long as the interval
and the watermark's delay, then evicted.
"""

from __future__ import annotations

from typing import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.attach import any_null, micros
from ..plans.compile import FAIL, PASS, quote

_UNITS = {"microsecond": 1, "millisecond": 1000, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86400 * 10**6, "week": 7 * 86400 * 10**6}


def interval_micros(text: str) -> int:
    """Microseconds of an interval like ``"90 minutes"`` or ``"1 day 6 hours"``."""
    words = text.lower().split()
    try:
        if not words or len(words) % 2:
            raise KeyError
        total = sum(int(n) * _UNITS[u.removesuffix("s")] for n, u in zip(words[::2], words[1::2]))
    except (KeyError, ValueError):
        raise ValueError(f"not an interval of fixed length: {text!r} (use weeks, days, hours, minutes, seconds)") from None
    if total <= 0:
        raise ValueError(f"the interval must be above 0: {text!r}")
    return total


def _clock(df: DataFrame, time_col: str) -> Column:
    return micros(F.col(quote(time_col)).cast("timestamp_ntz"))


def _names(df: DataFrame, *wanted: str) -> list[str]:
    out = []
    for w in wanted:
        while w in df.columns:
            w = "_" + w
        out.append(w)
    return out


def matched_within(df: DataFrame, keys: Sequence[str], time_col: str, first: Column, then: Column, within: str,
                   watermark: str | None = None, status: str = "status") -> DataFrame:
    """The rows for which ``first`` holds, each with ``status`` PASS iff a row of the same
    ``keys`` for which ``then`` holds came after it, at most ``within`` later.

    Later means a greater time, so a row of the same instant does not count, nor
    does the row itself.  NULL keys, times and conditions match nothing: such a
    first row is FAIL.  Rows that repeat are judged alike, and all are kept.

    A stream needs ``watermark``; a first row comes out with its match, or as FAIL
    when the watermark has passed its interval.  Rows without a time cannot be
    placed in a stream and stay out of it.  The state of a key is its rows of one
    interval and delay.  Rows that are equal in all columns come out once.
    """
    span = interval_micros(within)
    if status in df.columns:
        raise ValueError(f"the rows already have a column {status!r}; pass another name")
    if df.isStreaming:
        return _matched_stream(df, list(keys), time_col, first, then, within, watermark, status)
    at, is_first, is_then, stretch, follows, row = _names(df, "__at", "__first", "__then", "__stretch", "__follows", "__row")
    rows = df.withColumns({at: _clock(df, time_col), is_first: F.coalesce(first, F.lit(False)), is_then: F.coalesce(then, F.lit(False))})
    placed = ~any_null([F.col(at), *[F.col(quote(k)) for k in keys]])
    rows = rows.withColumn(is_then, F.col(is_then) & placed).where(F.col(is_first) | F.col(is_then))
    # a row that cannot be placed is a group of its own kind, spread by a draw
    rows = rows.withColumn(stretch, F.when(placed, F.floor(F.col(at) / span)).otherwise(F.floor(F.rand(17) * 4096)))
    named = [F.col(quote(k)) for k in keys]
    heads = rows.where(F.col(is_then)).groupBy(*named, stretch).agg(F.min(at).alias(at))
    # the first deciding event of a stretch stands at the end of the one before
    ghosts = heads.select(*named, at, (F.col(stretch) - 1).alias(stretch), F.lit(True).alias(is_then), F.lit(False).alias(is_first))
    whole = rows.select(*named, at, stretch, is_then, is_first, F.struct(*[F.col(quote(c)) for c in df.columns]).alias(row))
    both = whole.unionByName(ghosts, allowMissingColumns=True)
    # from late to early, so that the frame only grows
    later = Window.partitionBy(*named, stretch).orderBy(F.desc(at)).rangeBetween(Window.unboundedPreceding, -1)
    both = both.withColumn(follows, F.min(F.when(F.col(is_then), F.col(at))).over(later))
    good = F.coalesce(F.col(follows) - F.col(at) <= span, F.lit(False))
    return both.where(F.col(is_first)).select(f"{row}.*", F.when(good, PASS).otherwise(FAIL).alias(status))


def _matched_stream(df, keys, time_col, first, then, within, watermark, status):
    if watermark is None:
        raise ValueError("a stream needs a watermark: without one its state never ends")
    at, follows = _names(df, "__event_time", "__follows")
    timed = df.withColumn(at, F.col(quote(time_col)).cast("timestamp"))
    left = timed.where(first).withWatermark(at, watermark)
    right = timed.where(then).select(*[F.col(quote(k)).alias(f"__then_{i}") for i, k in enumerate(keys)], F.col(at).alias(follows)).withWatermark(follows, watermark)
    on = (F.col(follows) > F.col(at)) & (F.col(follows) <= F.col(at) + F.expr(f"INTERVAL {within}"))
    for i, k in enumerate(keys):
        on = on & (F.col(quote(k)) == F.col(f"__then_{i}"))
    joined = left.join(right, on, "leftOuter").withColumn(status, F.when(F.col(follows).isNull(), FAIL).otherwise(PASS))
    # one row for each first row, however many followed it
    once = joined.select(*[F.col(quote(c)) for c in df.columns], at, status).dropDuplicatesWithinWatermark([*df.columns])
    return once.drop(at)


def unique_within(df: DataFrame, keys: Sequence[str], time_col: str, within: str, order: Sequence[str] = (), watermark: str | None = None,
                  status: str = "status") -> DataFrame:
    """All rows, each with ``status`` FAIL iff it repeats: a row of the same ``keys``
    came before it, at most ``within`` earlier.  Repeats are marked, never dropped.

    Of rows of one instant the first in ``order`` (columns that tell them apart)
    came before the others.  NULL keys or times are FAIL (a stream leaves such
    rows out: they have no place in it).

    A stream needs ``watermark``.  Its state is one time per key, the latest seen,
    and expires when the watermark has passed it by ``within``.  Rows of a
    micro-batch are put in order; one that comes after a later row of its key is
    judged by its distance to that.  A restarted query goes on from its checkpoint.
    """
    span = interval_micros(within)
    if status in df.columns:
        raise ValueError(f"the rows already have a column {status!r}; pass another name")
    if df.isStreaming:
        return _unique_stream(df, list(keys), time_col, span, list(order), watermark, status)
    at, stretch, before, real = _names(df, "__at", "__stretch", "__before", "__real")
    rows = df.withColumn(at, _clock(df, time_col))
    named = [F.col(quote(k)) for k in keys]
    placed = ~any_null([F.col(at), *named])
    rows = rows.withColumns({stretch: F.when(placed, F.floor(F.col(at) / span)).otherwise(F.floor(F.rand(17) * 4096)), real: F.lit(True)})
    lasts = rows.where(placed).groupBy(*named, stretch).agg(F.max(at).alias(at))
    ghosts = lasts.select(*named, at, (F.col(stretch) + 1).alias(stretch), F.lit(False).alias(real))
    both = rows.unionByName(ghosts, allowMissingColumns=True)
    place = Window.partitionBy(*named, stretch).orderBy(at, *[F.col(quote(c)) for c in order])
    both = both.withColumn(before, F.lag(at).over(place))
    good = F.coalesce(F.col(at) - F.col(before) > span, F.col(before).isNull()) & placed
    return both.where(F.col(real)).select(*[F.col(quote(c)) for c in df.columns], F.when(good, PASS).otherwise(FAIL).alias(status))


def _judge(span: int, n_order: int):
    def judge(key, batches, state):
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        pdf = pd.concat(list(batches), ignore_index=True)
        pdf = pdf.sort_values(["__us", *[f"__o{i}" for i in range(n_order)]], kind="stable")
        verdicts = []
        for us in pdf["__us"].tolist():
            verdicts.append(FAIL if last is not None and abs(us - last) <= span else PASS)
            last = us if last is None else max(last, us)
        state.update((last,))
        state.setTimeoutTimestamp(max((last + span) // 1000, state.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame({"__row": pdf["__row"], "__status": verdicts})

    return judge


def _unique_stream(df, keys, time_col, span, order, watermark, status):
    if watermark is None:
        raise ValueError("a stream needs a watermark: without one its state never ends")
    at = F.col(quote(time_col)).cast("timestamp")
    # the row travels as JSON text, so that the state's code is the same for any columns
    whole = F.to_json(F.struct(*[F.col(quote(c)) for c in df.columns]), _JSON)
    one = F.to_json(F.struct(*[F.col(quote(k)) for k in keys]))
    rows = df.where(~any_null([at, *[F.col(quote(k)) for k in keys]])).select(
        one.alias("__key"), at.alias("__event_time"), F.unix_micros(at).alias("__us"),
        *[F.col(quote(c)).alias(f"__o{i}") for i, c in enumerate(order)], whole.alias("__row")).withWatermark("__event_time", watermark)
    judged = rows.groupBy("__key").applyInPandasWithState(_judge(span, len(order)), "__row string, __status string", "last long", "append", "EventTimeTimeout")
    back = F.from_json("__row", df.schema, _JSON).alias("r")
    return judged.select(back, F.col("__status")).select("r.*", F.col("__status").alias(status))


_JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
