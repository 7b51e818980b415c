"""FLT-1..10, AGG-1..8, TOP-4: search, paging and statistics over stored events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.model import PAGE_SIZE


def search(events: DataFrame, type: str | None = None, source: str | None = None,
           status: str | None = None, from_=None, to=None, mode: str = "precedence") -> DataFrame:
    """FLT-1..6.

    ``precedence`` (what the service does): type+source > type > source >
    status > (from and to) > all; lower-ranked arguments are ignored, and a lone
    from or to is ignored. ``conjunctive``: every given argument applies.
    Every filter is a plain comparison, so it reaches the Parquet scan as a
    pushed filter (and ``received_at`` prunes date partitions).
    """
    c = F.col
    if mode == "conjunctive":
        cond = F.lit(True)
        if type is not None:
            cond &= c("type") == type
        if source is not None:
            cond &= c("source") == source
        if status is not None:
            cond &= c("status") == status
        if from_ is not None:
            cond &= c("received_at") >= F.lit(from_).cast("timestamp")
        if to is not None:
            cond &= c("received_at") <= F.lit(to).cast("timestamp")
        return events.filter(cond)
    if type is not None and source is not None:
        return events.filter((c("type") == type) & (c("source") == source))
    if type is not None:
        return events.filter(c("type") == type)
    if source is not None:
        return events.filter(c("source") == source)
    if status is not None:
        return events.filter(c("status") == status)
    if from_ is not None and to is not None:
        return events.filter(c("received_at").between(F.lit(from_).cast("timestamp"), F.lit(to).cast("timestamp")))
    return events


def get_by_id(events: DataFrame, id: str) -> DataFrame:
    """FLT-7: at most one row (the caller raises on empty)."""
    return events.filter(F.col("id") == id).limit(1)


def page(df: DataFrame, page: int = 0, size: int = PAGE_SIZE, order: list[Column] | None = None,
         tiebreak: str = "id") -> DataFrame:
    """TOP-4: one page in a total order (a tie-break key is always appended).

    Planned as a TakeOrderedAndProject with offset: each task keeps its top
    ``(page+1)*size`` rows, so only that many rows per task are shuffled.
    For deep paging use :func:`page_deep` (any page), or :func:`page_after` (keyset), which is a filter.
    """
    order = list(order or [F.col("received_at").desc()])
    order.append(F.col(tiebreak).asc())
    return df.orderBy(*order).offset(page * size).limit(size)


def page_after(df: DataFrame, after_ts, after_id: str, size: int = PAGE_SIZE) -> DataFrame:
    """Keyset page for ``received_at desc, id asc`` after the given last row."""
    ts = F.lit(after_ts).cast("timestamp")
    cond = (F.col("received_at") < ts) | ((F.col("received_at") == ts) & (F.col("id") > after_id))
    return df.filter(cond).orderBy(F.col("received_at").desc(), F.col("id").asc()).limit(size)


#: Time units of a rank directory, from coarse to fine.
RANK_UNITS = ("day", "hour", "minute", "second")


def page_deep(df: DataFrame, page: int, size: int = PAGE_SIZE, settled: int = 10_000) -> DataFrame:
    """TOP-4 for any page of ``received_at desc, id asc``: the rows before it are counted, not sorted.

    A rank directory is looked up unit by unit: rows per day (of a landed table
    per ``received_date``, its partition), then per hour, minute and second of
    the units that hold the page, until at most ``settled`` rows are left to
    sort. Each step is a partially aggregated count over what the last step
    left, and a filter that prunes the partitions of a landed table; the counts
    (one per unit) are all that reaches the driver. Rows without a time are last.
    ``df`` is read once a step: store rows that are dear to derive (a parse) first,
    else every step derives all of them again.
    """
    skip = page * size
    for unit in RANK_UNITS:
        by_date = unit == "day" and "received_date" in df.columns
        key = F.col("received_date").cast("timestamp") if by_date else F.date_trunc(unit, "received_at")
        counts = df.groupBy(key.alias("u")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("u").desc_nulls_last()).collect()
        before, units, inside = 0, [], 0
        for r in counts:
            if before + inside + r["n"] <= skip and not units:
                before += r["n"]
            elif before + inside < skip + size:
                units.append(r["u"])
                inside += r["n"]
        if not units:
            return df.limit(0)
        skip -= before
        timed = [u for u in units if u is not None]
        keep = F.col("received_at").isNull() if None in units else F.lit(False)
        if timed:
            first, last = F.lit(min(timed)), F.lit(max(timed)) + F.expr(f"INTERVAL 1 {unit}")
            inside_time = (F.col("received_at") >= first) & (F.col("received_at") < last)
            keep = keep | inside_time if None in units else inside_time
            if "received_date" in df.columns and None not in units:
                df = df.filter(F.col("received_date").between(F.to_date(first), F.to_date(F.lit(max(timed)))))
        df = df.filter(keep)
        if inside <= settled or not timed:
            break
    return df.orderBy(F.col("received_at").desc(), F.col("id").asc()).offset(skip).limit(size)


def total(df: DataFrame) -> DataFrame:
    """AGG-1 (the page total)."""
    return df.agg(F.count(F.lit(1)).alias("total"))


def distinct_values(events: DataFrame, col: str) -> DataFrame:
    """AGG-2/3: sorted distinct values (partial aggregation before the shuffle)."""
    return events.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def stats(events: DataFrame) -> DataFrame:
    """AGG-4: total events and number of distinct types and sources, one pass."""
    return events.agg(F.count(F.lit(1)).alias("total_events"),
                      F.count_distinct("type").alias("types"),
                      F.count_distinct("source").alias("sources"))


def count_by(events: DataFrame, *cols: str) -> DataFrame:
    """AGG-5/6: counts per group (map-side partial aggregation)."""
    return events.groupBy(*cols).agg(F.count(F.lit(1)).alias("event_count"))


def trailing_window(events: DataFrame, as_of, minutes: int) -> DataFrame:
    """FLT-9: ``received_at`` in [as_of - minutes, as_of], both ends inclusive."""
    end = F.lit(as_of).cast("timestamp")
    return events.filter(F.col("received_at").between(end - F.expr(f"INTERVAL {int(minutes)} MINUTES"), end))


def parseable(df: DataFrame, text_col: str = "payload") -> DataFrame:
    """FLT-10: drop rows whose text is not JSON."""
    return df.filter(F.try_parse_json(F.col(text_col)).isNotNull())
