"""STR-1/STR-3: sliding-window counts, batch or streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.model import WINDOW_MINUTES


def _multiple(spark: SparkSession, length: str, slide: str) -> bool:
    """Whether ``length`` is a whole number of ``slide``s."""
    seconds = "unix_micros(timestamp '1970-01-01' + interval {})"
    return spark.sql(f"select {seconds.format(length)} % {seconds.format(slide)} = 0").first()[0]


def sliding_counts(events: DataFrame, length: str = f"{WINDOW_MINUTES} minutes", slide: str = "30 seconds",
                   watermark: str | None = None, ts_col: str = "received_at", chained: bool = False) -> DataFrame:
    """Counts per (window, type, source): the 5-minute trailing count
    re-evaluated every 30 s. Windows are half-open ``[start, end)`` (the
    reference's polled SQL uses an inclusive end). On a stream, ``watermark``
    bounds state: events later than it are dropped (STR-3; the reference
    counts an event only if it is inside the window at check time).
    Events are counted per slide first and only those counts are spread over
    the windows (a slide lies whole in each, when the length is a multiple of
    it). A stream does so if ``chained``: its two stateful aggregations hang
    together by the time of the slide windows, which Spark allows in append
    mode only; otherwise it spreads each event over its windows.
    """
    if watermark is not None:
        events = events.withWatermark(ts_col, watermark)
    n, at = F.count(F.lit(1)), F.col(ts_col)
    if (chained or not events.isStreaming) and _multiple(events.sparkSession, length, slide):
        events = events.groupBy(F.window(at, slide).alias("w"), "type", "source").agg(n.alias("n"))
        n, at = F.sum("n"), F.window_time("w")  # the last instant of the slide
    w = F.window(at, length, slide)
    return (events.groupBy(w.alias("w"), "type", "source").agg(n.alias("event_count"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "type", "source", "event_count"))
