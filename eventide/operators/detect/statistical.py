"""STAT-1..4, WIN-1, JN-2, AGG-6..8: volume spikes and drops.

Replay form: each (type, source, window) with events is one check. The
history a check sees is every earlier check of the same key (avg and sample
stddev over ``rows between unbounded preceding and 1 preceding``), exactly
what the reference reads from its baseline table *before* saving the current
window. The first two checks of a key therefore never alert.
Counting is a partially aggregated ``groupBy``; the window function then runs
over one row per (key, window), never over raw events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.model import DROP_RATIO, MIN_EVENTS, SPIKE_Z, WINDOW_MINUTES


def window_counts(events: DataFrame, window: str, ts_col: str = "received_at",
                  start_time: str | None = None) -> DataFrame:
    """AGG-6: events per (type, source, tumbling window).

    Windows are epoch-aligned, shifted by ``start_time`` (``'4 days'`` gives
    Monday-aligned weeks)."""
    w = F.window(F.col(ts_col), window, window, start_time) if start_time else F.window(F.col(ts_col), window)
    return (events.groupBy(F.col("type").alias("event_type"), F.col("source").alias("event_source"),
                           w.alias("w"))
            .agg(F.count(F.lit(1)).alias("event_count"))
            .select("event_type", "event_source", F.col("w.start").alias("window_start"),
                    F.col("w.end").alias("window_end"), "event_count"))


def baselines(counts: DataFrame) -> DataFrame:
    """WIN-1 + AGG-7/8: the baseline row each check saves (SNK-5 image)."""
    hist = (Window.partitionBy("event_type", "event_source").orderBy("window_start")
            .rowsBetween(Window.unboundedPreceding, -1))
    avg = F.avg("event_count").over(hist)
    std = F.stddev_samp("event_count").over(hist)
    b = counts.withColumns({"avg_count": avg, "stddev_count": std})
    # "if either is NULL, save both as NULL" (first check: no rows; second: one row)
    none = b.avg_count.isNull() | b.stddev_count.isNull()
    return b.withColumns({"avg_count": F.when(~none, F.col("avg_count")),
                          "stddev_count": F.when(~none, F.col("stddev_count"))})


def volume_alerts(base: DataFrame, window_minutes: int = WINDOW_MINUTES, spike_z: float = SPIKE_Z,
                  drop_ratio: float = DROP_RATIO, min_events: int = MIN_EVENTS) -> DataFrame:
    """STAT-2..4: spike (HIGH) and drop (MEDIUM) alert rows."""
    c, a, s = F.col("event_count"), F.col("avg_count"), F.col("stddev_count")
    guarded = base.filter(a.isNotNull() & s.isNotNull() & (s != 0) & (c >= min_events))
    z = (c - a) / s
    spikes = guarded.filter(z > spike_z).select(
        "event_type", "event_source", "window_start", "event_count", "avg_count", "stddev_count",
        z.alias("score"), F.lit("HIGH").alias("severity"), F.lit("Volume spike detected").alias("title"),
        F.format_string("%s events from %s: %d events in last %d min (avg: %.0f, z-score: %.1f)",
                        "event_type", "event_source", c, F.lit(window_minutes), a, z).alias("description"))
    drop_pct = (F.lit(1.0) - c / a) * 100
    drops = guarded.filter((c < a * drop_ratio) & (a > min_events)).select(
        "event_type", "event_source", "window_start", "event_count", "avg_count", "stddev_count",
        drop_pct.alias("score"), F.lit("MEDIUM").alias("severity"), F.lit("Volume drop detected").alias("title"),
        F.format_string("%s events from %s: %d events in last %d min (avg: %.0f, drop: %.0f%%)",
                        "event_type", "event_source", c, F.lit(window_minutes), a, drop_pct).alias("description"))
    return spikes.unionByName(drops).withColumn("detector_type", F.lit("STATISTICAL"))


def detect_volume(events: DataFrame, window: str = "5 minutes", window_minutes: int | None = None,
                  start_time: str | None = None, **thresholds) -> tuple[DataFrame, DataFrame]:
    """Replay the volume detector over whole history: (baselines, alerts)."""
    base = baselines(window_counts(events, window, start_time=start_time))
    minutes = window_minutes if window_minutes is not None else _minutes(window)
    return base, volume_alerts(base, minutes, **thresholds)


def live_check(events: DataFrame, history: DataFrame | None, as_of, window_minutes: int = WINDOW_MINUTES,
               **thresholds) -> tuple[DataFrame, DataFrame]:
    """STR-4 / FLT-9 live form: one check at ``as_of`` against the saved baselines.

    Counts over ``[as_of - window, as_of]`` (both ends inclusive), history
    aggregated once per key and joined (JN-2, AQE broadcasts it when small).
    Returns the new baseline rows (to append) and the alerts.
    """
    end = F.lit(as_of).cast("timestamp")
    start = end - F.expr(f"INTERVAL {int(window_minutes)} MINUTES")
    cur = (events.filter(F.col("received_at").between(start, end))
           .groupBy(F.col("type").alias("event_type"), F.col("source").alias("event_source"))
           .agg(F.count(F.lit(1)).alias("event_count"))
           .withColumns({"window_start": start, "window_end": end}))
    hist = None if history is None else history.groupBy("event_type", "event_source").agg(
        F.avg("event_count").alias("h_avg"), F.stddev_samp("event_count").alias("h_std"))
    return check_counts(cur, hist, window_minutes, **thresholds)


def check_counts(cur: DataFrame, hist: DataFrame | None, window_minutes: int = WINDOW_MINUTES,
                 **thresholds) -> tuple[DataFrame, DataFrame]:
    """A check from its counts and the history of each key (``h_avg``, ``h_std``): (baseline rows, alerts)."""
    if hist is None:
        hist = cur.select("event_type", "event_source").limit(0).withColumns(
            {"h_avg": F.lit(None).cast("double"), "h_std": F.lit(None).cast("double")})
    j = cur.join(hist, ["event_type", "event_source"], "left")
    none = F.col("h_avg").isNull() | F.col("h_std").isNull()
    base = j.select("event_type", "event_source", "window_start", "window_end", "event_count",
                    F.when(~none, F.col("h_avg")).alias("avg_count"),
                    F.when(~none, F.col("h_std")).alias("stddev_count"))
    return base, volume_alerts(base, window_minutes, **thresholds)


def _minutes(window: str) -> int:
    n, unit = window.split()
    mult = {"second": 1 / 60, "minute": 1, "hour": 60, "day": 1440, "week": 10080}
    return int(float(n) * mult[unit.rstrip("s")])
