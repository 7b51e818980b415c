"""DRIFT-1/2, WIN-2, SET-1/2/4, FN-5/14, AGG-10/13/15: schema drift.

Replay form: every (type, check) sample set is one check; the snapshot a
check compares against is the previous check of the same type (the
reference's latest snapshot by ``last_seen_at`` is always the one the
previous check inserted or touched), read with ``lag``. First check of a
type saves, same hash touches, a different hash alerts (names only).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.text import drift_text, schema_hash
from eventide.model import SCHEMA_SAMPLE, SCHEMA_SNAPSHOTS
from eventide.operators.discovery import field_sets
from eventide.operators.sampling import latest_n


def check_samples(events: DataFrame, check: str | None = None, n: int | None = SCHEMA_SAMPLE) -> DataFrame:
    """TOP-1: latest ``n`` payloads per type (per check window when ``check``
    is a window length such as ``'1 day'``)."""
    ev = events.select("id", "type", "payload", "stored_at")
    if check:
        ev = ev.withColumn("check_at", F.window("stored_at", check).end)
    else:
        ev = ev.withColumn("check_at", F.lit(None).cast("timestamp"))
    return latest_n(ev, ["type", "check_at"], [F.col("stored_at").desc(), F.col("id").desc()], n)


def current_schemas(samples: DataFrame) -> DataFrame:
    """Per (type, check): field set, hash and sample count."""
    parsed = samples.withColumn("payload", F.try_parse_json("payload"))  # FLT-10: non-JSON skipped
    cur = field_sets(parsed, ["type", "check_at"], count_col="sample_count")
    return cur.withColumn("schema_hash", schema_hash(F.col("field_names")))


def schema_checks(samples: DataFrame) -> DataFrame:
    """The schemas of every check and the comparison with the previous one:
    ``outcome`` FIRST / SAME / DRIFT."""
    return compare_checks(current_schemas(samples))


def compare_checks(cur: DataFrame) -> DataFrame:
    """Compare every check with the one before it of the same type."""
    w = Window.partitionBy("type").orderBy("check_at")
    return outcomes(cur.withColumns({"prev_hash": F.lag("schema_hash").over(w),
                                     "prev_fields": F.lag("field_names").over(w)}))


def outcomes(cur: DataFrame) -> DataFrame:
    """Outcome and field differences of checks with ``prev_hash`` and ``prev_fields``."""
    added = F.array_except("field_names", "prev_fields")
    removed = F.array_except("prev_fields", "field_names")
    outcome = (F.when(F.col("prev_hash").isNull(), "FIRST")
               .when(F.col("prev_hash") == F.col("schema_hash"), "SAME").otherwise("DRIFT"))
    return cur.withColumns({
        "outcome": outcome,
        "added": F.when(outcome == "DRIFT", F.array_sort(added)),
        "removed": F.when(outcome == "DRIFT", F.array_sort(removed)),
    })


def drift_alerts(checks: DataFrame) -> DataFrame:
    """DRIFT-2: MEDIUM alert rows for checks whose hash changed."""
    d = checks.filter(F.col("outcome") == "DRIFT")
    return d.select(
        F.lit("SCHEMA_DRIFT").alias("detector_type"), F.lit("MEDIUM").alias("severity"),
        F.col("type").alias("event_type"), F.lit(None).cast("string").alias("event_source"),
        "check_at", "added", "removed",
        F.concat(F.lit("Schema change detected for "), F.col("type")).alias("title"),
        drift_text(F.col("added"), F.col("removed")).alias("description"))


def snapshots(checks: DataFrame) -> DataFrame:
    """SNK-6/7/8 image: one snapshot per (type, hash); first/last seen checks.

    A check with the same hash as the one before (SAME) touches its snapshot:
    the last such check gives ``sample_count``. A drift back to a known hash
    only moves ``last_seen_at``; a snapshot never touched keeps the count of the
    check that wrote it, and ``field_names`` are always of that check.
    """
    touched = F.max_by(F.when(F.col("outcome") == "SAME", F.col("sample_count")),
                       F.when(F.col("outcome") == "SAME", F.col("check_at")))
    return checks.groupBy(F.col("type").alias("event_type"), "schema_hash").agg(
        F.min_by("field_names", "check_at").alias("field_names"),
        F.coalesce(touched, F.min_by("sample_count", "check_at")).cast("int").alias("sample_count"),
        F.min("check_at").alias("first_seen_at"),
        F.max("check_at").alias("last_seen_at"))


def latest_snapshots(image: DataFrame) -> DataFrame:
    """TOP-3: the snapshot of each type that was seen last: type, prev_hash, prev_fields."""
    order = F.struct("last_seen_at", "schema_hash")
    return image.groupBy(F.col("event_type").alias("type")).agg(
        F.max_by("schema_hash", order).alias("prev_hash"), F.max_by("field_names", order).alias("prev_fields"))


def merge_snapshots(image: DataFrame, checks: DataFrame) -> DataFrame:
    """SNK-6/7/8: the snapshot table after one check of each type (the rules of :func:`snapshots`)."""
    c = checks.select(F.col("type").alias("event_type"), "schema_hash", F.col("field_names").alias("__fields"),
                      F.col("sample_count").cast("int").alias("__count"), F.col("check_at").alias("__at"), "outcome")
    count = F.when(F.col("outcome") == "SAME", F.col("__count")).otherwise(F.coalesce("sample_count", "__count"))
    return image.join(c, ["event_type", "schema_hash"], "full").select(
        "event_type", "schema_hash", F.coalesce("field_names", "__fields").alias("field_names"), count.alias("sample_count"),
        F.coalesce("first_seen_at", "__at").alias("first_seen_at"), F.greatest("last_seen_at", "__at").alias("last_seen_at"))


def one_image(images: DataFrame) -> DataFrame:
    """One snapshot table from those that several runs have left: the row seen last per (type, hash), from the earliest on."""
    last = F.struct("last_seen_at", "sample_count")
    return images.groupBy("event_type", "schema_hash").agg(
        F.min_by("field_names", "first_seen_at").alias("field_names"), F.max_by("sample_count", last).alias("sample_count"),
        F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"))
