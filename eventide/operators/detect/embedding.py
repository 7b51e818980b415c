"""EMB-1, JN-4, AGG-12, FN-6/7: content outliers from embedding vectors.

Per type: the latest ``sample`` events (TOP-2), at least 3 of them and at
least 3 usable vectors; centroid = element-wise mean; an event further than
``threshold`` (cosine distance) from its type's centroid is a LOW alert.
Vectors come from a column (the reference calls an embedding service).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.vectors import cosine_distance, vector_sums
from eventide.model import EMBED_BATCH, EMBED_MIN_EVENTS, EMBED_THRESHOLD
from eventide.operators.sampling import latest_n


def distances(vectors: DataFrame, sample: int | None = EMBED_BATCH, min_events: int = EMBED_MIN_EVENTS) -> DataFrame:
    """(id, type, distance) for every sampled event of an eligible type.

    The centroid table has one row per type (size checked by AQE at run time,
    broadcast when small, sort-merge otherwise); vectors never leave their
    partitions except through that join.
    """
    s = latest_n(vectors, ["type"], [F.col("seq").desc()], sample)
    # eligibility and centroid of a type from one aggregation joined back (not a
    # window over the type, which would put a hot type in one task)
    c = vector_sums(s).filter((F.col("n") >= min_events) & (F.col("usable") >= min_events) & F.col("dims_ok")
                              & (F.size("centroid") > 0))
    s = s.filter(F.col("vector").isNotNull())
    j = s.join(c.select("type", "centroid"), "type")
    return j.select("id", "type", "seq", cosine_distance(F.col("vector"), F.col("centroid")).alias("distance"))


def outliers(vectors: DataFrame, threshold: float = EMBED_THRESHOLD, sample: int | None = EMBED_BATCH,
             min_events: int = EMBED_MIN_EVENTS) -> DataFrame:
    d = distances(vectors, sample, min_events).filter(F.col("distance") > threshold)
    return d.select(
        F.lit("EMBEDDING").alias("detector_type"), F.lit("LOW").alias("severity"),
        F.col("type").alias("event_type"), F.lit(None).cast("string").alias("event_source"),
        F.col("id").alias("event_id"), "distance",
        F.lit("Content anomaly detected").alias("title"),
        F.format_string("Event %s has unusual content for type %s (distance: %.4f, threshold: %.4f)",
                        F.col("id"), F.col("type"), F.col("distance"), F.lit(float(threshold))).alias("description"))
