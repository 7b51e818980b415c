"""FN-5, FN-10, FN-14: schema hash and alert texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def set_text(arr: Column) -> Column:
    """Sorted-set text ``[a, b]`` (the reference prints its sorted set this way)."""
    return F.concat(F.lit("["), F.array_join(arr, ", "), F.lit("]"))


def schema_hash(fields: Column) -> Column:
    """FN-5: first 16 hex chars of SHA-256 over the sorted field-set text."""
    return F.substring(F.sha2(set_text(fields), 256), 1, 16)


def drift_text(added: Column, removed: Column) -> Column:
    """FN-14: ``New fields: [..]. Missing fields: [..].`` (empty parts omitted)."""
    a = F.when(F.size(added) > 0, F.concat(F.lit("New fields: "), set_text(added), F.lit(". ")))
    r = F.when(F.size(removed) > 0, F.concat(F.lit("Missing fields: "), set_text(removed), F.lit(". ")))
    return F.trim(F.concat(F.coalesce(a, F.lit("")), F.coalesce(r, F.lit(""))))
