"""FN-6/7, AGG-12: vector maths as array expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x * x))


def cosine_similarity(a: Column, b: Column) -> Column:
    """FN-6: 0 when either norm is 0; NULL when the lengths differ (an error
    in the reference; callers flag it with :func:`same_length`)."""
    den = norm(a) * norm(b)
    return F.when(F.size(a) != F.size(b), F.lit(None).cast("double")) \
        .when(den == 0.0, F.lit(0.0)).otherwise(dot(a, b) / den)


def cosine_distance(a: Column, b: Column) -> Column:
    """FN-7."""
    return F.lit(1.0) - cosine_similarity(a, b)


def same_length(a: Column, b: Column) -> Column:
    return F.size(a) == F.size(b)


def vector_sums(vectors: DataFrame, key: str = "type", vec: str = "vector") -> DataFrame:
    """Mean vector and counts per key from one read: ``(key, n, usable, centroid, dims_ok)``.

    Every row leaves its components by position and a marker; sums and counts
    per (key, position) are combined map-side, so a key holding a third of all
    vectors costs ``dims + 1`` rows per task. ``n`` counts rows, ``usable`` those
    with a vector; ``dims_ok`` is false where vectors of a key differ in length
    (the reference raises for that key): some position is then not in all.
    """
    v = F.col(vec)
    parts = F.concat(F.array(F.struct(F.lit(-1).alias("pos"), v.isNotNull().cast("double").alias("x"))),
                     F.coalesce(F.transform(v, lambda x, i: F.struct(i.alias("pos"), x.cast("double").alias("x"))),
                                F.array().cast("array<struct<pos:int,x:double>>")))
    sums = vectors.select(key, F.explode(parts).alias("e")).groupBy(key, F.col("e.pos").alias("pos")).agg(
        F.sum("e.x").alias("s"), F.avg("e.x").alias("x"), F.count(F.lit(1)).alias("n"))
    marker = F.col("pos") == -1
    out = sums.groupBy(key).agg(
        F.max(F.when(marker, F.col("n"))).alias("n"), F.max(F.when(marker, F.col("s"))).cast("long").alias("usable"),
        F.min(F.when(~marker, F.col("n"))).alias("__least"),
        F.array_sort(F.collect_list(F.when(~marker, F.struct("pos", "x")))).alias("__c"))
    return out.select(key, "n", "usable", F.transform("__c", lambda e: e["x"]).alias("centroid"),
                      F.coalesce(F.col("__least") == F.col("usable"), F.lit(True)).alias("dims_ok"))


def centroids(vectors: DataFrame, key: str = "type", vec: str = "vector") -> DataFrame:
    """AGG-12: element-wise mean per key -> ``(key, centroid array<double>, n, dims_ok)``, for keys with components."""
    sums = vector_sums(vectors, key, vec).filter(F.size("centroid") > 0)
    return sums.select(key, "centroid", F.col("usable").alias("n"), "dims_ok")
