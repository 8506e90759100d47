"""Streaming runs of the same compiled checks, windowed verdict counts, and events judged by other events."""

from .matched import matched_within, unique_within
from .quality import annotate_stream, quality_by_window, rows_without_time, stream_checkpoint, write_annotated_stream

__all__ = ["annotate_stream", "matched_within", "quality_by_window", "rows_without_time", "stream_checkpoint", "unique_within", "write_annotated_stream"]
