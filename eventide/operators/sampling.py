"""TOP-1/2/3/5: latest-N per group and latest-per-key selections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int | None) -> DataFrame:
    """Top ``n`` rows per group by ``order`` (descending expressions given).

    ``row_number() <= n`` is planned with Spark's window-group limit, so each
    map task keeps only ``n`` rows per group before the shuffle: a group
    holding a third of the data still ships only ``n`` rows per task.
    ``n=None`` keeps every row (full-table mode).
    """
    if n is None:
        return df
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def latest_one(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """TOP-3/TOP-5: the row with the greatest ``order_col`` per key (``max_by``)."""
    from eventide.operators.store import last_per_key
    return last_per_key(df, keys, [F.col(order_col)])
