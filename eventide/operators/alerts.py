"""SNK-9/10, FLT-8, AGG-9: the alert table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALERT_COLS = ["detector_type", "severity", "event_type", "event_source", "event_id", "title",
              "description", "details"]


def to_alerts(rows: DataFrame, key_cols: list[str]) -> DataFrame:
    """SNK-9: alert rows (resolved = false, created_at = now) with a stable id
    derived from the detector and the check that raised it."""
    for c in ALERT_COLS:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    key = F.concat_ws("|", F.col("detector_type"), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key_cols])
    return rows.select(F.substring(F.sha2(key, 256), 1, 20).alias("id"), *ALERT_COLS,
                       F.lit(False).alias("resolved"), F.current_timestamp().alias("created_at"))


def resolve(alerts: DataFrame, resolutions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SNK-10: apply a table of alert ids to resolve, in one pass.

    Returns (new alert table image, unknown ids -- an error per id in the
    reference).
    """
    r = resolutions.select("id").distinct().withColumn("__hit", F.lit(True))
    out = alerts.join(r, "id", "left").withColumn(
        "resolved", F.col("resolved") | F.coalesce(F.col("__hit"), F.lit(False))).drop("__hit")
    unknown = resolutions.select("id").distinct().join(alerts.select("id"), "id", "left_anti")
    return out, unknown


def filter_alerts(alerts: DataFrame, detector_type: str | None = None, severity: str | None = None,
                  event_type: str | None = None, resolved: bool | None = None) -> DataFrame:
    """FLT-8: detectorType > severity > eventType > resolved > all (first given wins)."""
    if detector_type is not None:
        return alerts.filter(F.col("detector_type") == detector_type)
    if severity is not None:
        return alerts.filter(F.col("severity") == severity)
    if event_type is not None:
        return alerts.filter(F.col("event_type") == event_type)
    if resolved is not None:
        return alerts.filter(F.col("resolved") == F.lit(resolved))
    return alerts


def alert_stats(alerts: DataFrame) -> DataFrame:
    """AGG-9: total, open, resolved in one aggregation."""
    return alerts.agg(F.count(F.lit(1)).alias("total"),
                      F.count_if(~F.col("resolved")).alias("open"),
                      F.count_if(F.col("resolved")).alias("resolved"))
