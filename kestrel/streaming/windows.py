"""Event-time stream jobs: windowed counts, and de-duplication within the watermark (``late.py`` also keeps late rows).

All of them are stateful Structured Streaming operators bounded by a watermark, so state
is evicted as event time advances; with append output a window is emitted once the
watermark passes its end (the newest window stays open until later data arrives).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(df: DataFrame, ts: str, keys: Sequence[str], size: str = "1 hour", slide: str | None = None,
                    delay: str = "10 minutes", session_gap: str | None = None) -> DataFrame:
    """Counts per (window, keys): tumbling (``size``), sliding (``slide``) or session (``session_gap``).

    On a streaming frame the watermark bounds state; on a batch frame it is ignored.
    """
    src = df.withWatermark(ts, delay) if df.isStreaming else df
    if session_gap:
        w = F.session_window(F.col(ts), session_gap)
    elif slide:
        w = F.window(F.col(ts), size, slide)
    else:
        w = F.window(F.col(ts), size)
    agg = src.groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n")


def dedupe(df: DataFrame, keys: Sequence[str], ts: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Drop repeated keys. Streams: state kept only within the watermark delay; batch: exact."""
    if df.isStreaming:
        if ts is None:
            raise ValueError("streaming dedup needs an event-time column")
        return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
    return df.dropDuplicates(list(keys))
