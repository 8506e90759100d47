"""Checks on streams, and verdict counts per event-time window.

The compiled checks are row-local projections, so ``Pipeline.run`` applies
to a streaming DataFrame unchanged (no state).  ``quality_by_window`` adds
the one stateful piece, a windowed count of verdicts per rule; it works on a
batch DataFrame and on a stream (with ``watermark`` so that late rows are
bounded and finished windows are emitted in append mode).

The aggregate holds one partial row per (window, task): N conditional counts,
not one row per (row, rule), and the rules are unpacked only after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from ..plans.compile import CompiledPipeline, quote
from ..plans.pipeline import Pipeline


def annotate_stream(pipeline: Pipeline, stream: DataFrame) -> DataFrame:
    """``pipeline.run`` on a streaming source; stateless, any output mode."""
    return pipeline.run(stream)


def quality_by_window(
    run: CompiledPipeline,
    time_col: str,
    window: str,
    slide: str | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """``window_start, window_end, rule_id, n_pass, n_fail, n_rows``.

    With ``watermark`` on a ``timestamp_ntz`` column, the event time is read
    in the session time zone (pin UTC for wall-clock windows); the window
    bounds come back as ``timestamp_ntz``.

    No row is dropped from a batch: rows whose event time is NULL are counted
    under a NULL window.  A stream cannot place them in any window; read them
    with :func:`rows_without_time` beside this one."""
    staged = run.staged
    if not run.rules:
        kind = "timestamp_ntz" if isinstance(staged.schema[time_col].dataType, TimestampNTZType) else "timestamp"
        none = F.lit(None).cast(kind)
        zero = F.lit(0).cast("long")
        return staged.where(F.lit(False)).select(none.alias("window_start"), none.alias("window_end"), F.lit("").alias("rule_id"),
                                                 zero.alias("n_pass"), zero.alias("n_fail"), zero.alias("n_rows"))
    ts = F.col(quote(time_col))
    ntz = isinstance(staged.schema[time_col].dataType, TimestampNTZType)
    if watermark is not None:
        if ntz:
            # watermarks need TIMESTAMP: read the wall clock in the session zone
            staged = staged.withColumn("__event_time", ts.cast("timestamp"))
            ts = F.col("__event_time")
            staged = staged.withWatermark("__event_time", watermark)
        else:
            staged = staged.withWatermark(time_col, watermark)
    aggs = [F.count_if(F.col(r.flag)).alias(f"p{i}") for i, r in enumerate(run.rules)]
    entries = F.array(*[F.struct(F.lit(r.id).alias("rule_id"), F.col(f"p{i}").alias("n_pass")) for i, r in enumerate(run.rules)])
    if staged.isStreaming:
        w = F.window(ts, window, slide) if slide else F.window(ts, window)
        per_window = staged.groupBy(w.alias("w")).agg(*aggs, F.count(F.lit(1)).alias("n"))
    else:
        # one pass: untimed rows go to the window that begins with the epoch, in groups of their own
        kind = staged.schema[time_col].dataType if watermark is None or not ntz else TimestampType()
        epoch = F.timestamp_micros(F.lit(0)) if isinstance(kind, TimestampType) else F.lit("1970-01-01").cast(kind)
        at = F.coalesce(ts, epoch)
        w = F.window(at, window, slide) if slide else F.window(at, window)
        per_window = staged.groupBy(w.alias("w"), ts.isNull().alias("untimed")).agg(*aggs, F.count(F.lit(1)).alias("n"))
        if slide:  # several windows hold the epoch: the rows count in the last of them
            per_window = per_window.where(~F.col("untimed") | (F.col("w.start") + F.expr(f"INTERVAL {slide}") > epoch))
        per_window = per_window.select(F.when(~F.col("untimed"), F.col("w")).alias("w"), *[f"p{i}" for i in range(len(aggs))], "n")
    start, end = F.col("w.start"), F.col("w.end")
    if ntz and watermark is not None:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    return per_window.select(start.alias("window_start"), end.alias("window_end"), F.col("n"), F.inline(entries)).select(
        "window_start",
        "window_end",
        "rule_id",
        "n_pass",
        (F.col("n") - F.col("n_pass")).alias("n_fail"),
        F.col("n").alias("n_rows"),
    )


def rows_without_time(run: CompiledPipeline, time_col: str) -> DataFrame:
    """The annotated rows whose event time is NULL: the side output of
    ``quality_by_window`` on a stream."""
    return run.annotated().where(F.col(quote(time_col)).isNull())


def stream_checkpoint(spark, name: str) -> str:
    """Checkpoint folder for a streaming query, under the shared folder the
    session names (``spark.checkpoint.dir``), so a restarted query or a lost
    executor resumes from the same state.  Raises where the session names none:
    the context's own checkpoint folder is a new one in every application."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("no spark.checkpoint.dir in this session: set it to a shared folder "
                         "or pass a checkpoint location yourself")
    return f"{base.rstrip('/')}/rowlint-streams/{name}"


def write_annotated_stream(pipeline: Pipeline, stream: DataFrame, path: str, name: str,
                           format: str = "parquet", available_now: bool = False):
    """Start writing the annotated stream to ``path`` (append, exactly-once
    file sink) with its checkpoint under ``spark.checkpoint.dir``."""
    spark = stream.sparkSession
    w = (annotate_stream(pipeline, stream).writeStream.format(format).outputMode("append")
         .option("path", path).option("checkpointLocation", stream_checkpoint(spark, name)).queryName(name))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
