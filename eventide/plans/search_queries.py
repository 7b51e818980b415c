"""Search, paging and statistics queries (FLT-*, AGG-1..6, TOP-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators import search as S
from eventide.plans.registry import query
from eventide.sources.adapters import stored_events

# Oracle view of stored_events over the driver table (same rule as the adapter).
SE = """(SELECT 'evt_' || CAST(event_id AS VARCHAR) AS id, event_type AS type,
  'src-' || CAST(user_id % 5 AS VARCHAR) AS source, props AS payload,
  CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'PROCESSED' END AS status,
  ts AS received_at FROM events)"""

ROW = "id, type, source, status, strftime(received_at, '%Y-%m-%d %H:%M:%S') AS received_at"


def _rows(df):
    return df.select("id", "type", "source", "status",
                     F.date_format("received_at", "yyyy-MM-dd HH:mm:ss").alias("received_at"))


@query("search_by_type", f"SELECT {ROW} FROM {SE} WHERE type = 'purchase'")
def search_by_type(spark, sf):
    return _rows(S.search(stored_events(spark, sf), type="purchase"))


@query("search_by_source", f"SELECT {ROW} FROM {SE} WHERE source = 'src-3'")
def search_by_source(spark, sf):
    return _rows(S.search(stored_events(spark, sf), source="src-3"))


@query("search_type_source", f"SELECT {ROW} FROM {SE} WHERE type = 'click' AND source = 'src-1'")
def search_type_source(spark, sf):
    return _rows(S.search(stored_events(spark, sf), type="click", source="src-1"))


@query("search_by_status", f"SELECT {ROW} FROM {SE} WHERE status = 'FAILED'")
def search_by_status(spark, sf):
    return _rows(S.search(stored_events(spark, sf), status="FAILED"))


@query("search_time_range", f"SELECT {ROW} FROM {SE} WHERE received_at BETWEEN "
       "TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 12:00:00'")
def search_time_range(spark, sf):
    return _rows(S.search(stored_events(spark, sf), from_="2024-01-10 00:00:00", to="2024-01-12 12:00:00"))


@query("search_precedence", f"SELECT {ROW} FROM {SE} WHERE source = 'src-2'")
def search_precedence(spark, sf):
    # source outranks status and the time range: both are ignored
    return _rows(S.search(stored_events(spark, sf), source="src-2", status="FAILED",
                          from_="2024-01-10 00:00:00", to="2024-01-11 00:00:00"))


@query("search_conjunctive", f"SELECT {ROW} FROM {SE} WHERE source = 'src-2' AND status = 'FAILED' "
       "AND received_at BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'")
def search_conjunctive(spark, sf):
    return _rows(S.search(stored_events(spark, sf), source="src-2", status="FAILED",
                          from_="2024-01-10 00:00:00", to="2024-01-20 00:00:00", mode="conjunctive"))


@query("get_by_id", f"SELECT {ROW} FROM {SE} WHERE id = 'evt_42'")
def get_by_id(spark, sf):
    return _rows(S.get_by_id(stored_events(spark, sf), "evt_42"))


@query("search_page", f"SELECT {ROW} FROM {SE} WHERE type = 'view' "
       "ORDER BY received_at DESC, id LIMIT 50 OFFSET 100")
def search_page(spark, sf):
    return _rows(S.page(S.search(stored_events(spark, sf), type="view"), page=2, size=50))


@query("search_page_total", f"SELECT count(*) AS total FROM {SE} WHERE type = 'view'")
def search_page_total(spark, sf):
    return S.total(S.search(stored_events(spark, sf), type="view"))


@query("distinct_types", f"SELECT DISTINCT type FROM {SE} ORDER BY type")
def distinct_types(spark, sf):
    return S.distinct_values(stored_events(spark, sf), "type")


@query("distinct_sources", f"SELECT DISTINCT source FROM {SE} ORDER BY source")
def distinct_sources(spark, sf):
    return S.distinct_values(stored_events(spark, sf), "source")


@query("event_stats", f"SELECT count(*) AS total_events, count(DISTINCT type) AS types, "
       f"count(DISTINCT source) AS sources FROM {SE}")
def event_stats(spark, sf):
    return S.stats(stored_events(spark, sf))


@query("counts_by_type_source", f"SELECT type, source, count(*) AS event_count FROM {SE} GROUP BY type, source")
def counts_by_type_source(spark, sf):
    return S.count_by(stored_events(spark, sf), "type", "source")


@query("counts_by_status", f"SELECT status, count(*) AS event_count FROM {SE} GROUP BY status")
def counts_by_status(spark, sf):
    return S.count_by(stored_events(spark, sf), "status")


@query("trailing_window_counts", f"SELECT type, source, count(*) AS event_count FROM {SE} "
       "WHERE received_at BETWEEN TIMESTAMP '2024-01-15 00:00:00' AND TIMESTAMP '2024-01-15 12:00:00' "
       "GROUP BY type, source")
def trailing_window_counts(spark, sf):
    ev = S.trailing_window(stored_events(spark, sf), "2024-01-15 12:00:00", 720)
    return S.count_by(ev, "type", "source")


@query("search_keyset_page", f"SELECT {ROW} FROM {SE} WHERE type = 'view' AND (received_at < "
       "TIMESTAMP '2024-01-20 00:00:00' OR (received_at = TIMESTAMP '2024-01-20 00:00:00' AND id > 'evt_0')) "
       "ORDER BY received_at DESC, id LIMIT 50")
def search_keyset_page(spark, sf):
    """TOP-4 keyset form: the page after a given (received_at, id), a pushed-down filter."""
    ev = S.search(stored_events(spark, sf), type="view")
    return _rows(S.page_after(ev, "2024-01-20 00:00:00", "evt_0", 50))


@query("document_stats", "SELECT count(*) AS total_events, count(DISTINCT lang) AS types, "
       "count(DISTINCT source) AS sources FROM documents")
def document_stats(spark, sf):
    """AGG-4 over a second event source (documents: type = lang)."""
    from eventide.sources.adapters import document_events
    return S.stats(document_events(spark, sf))


@query("document_counts", "SELECT lang AS type, source, count(*) AS event_count FROM documents GROUP BY lang, source")
def document_counts(spark, sf):
    """AGG-6 over documents; the whole text is carried in the payload but pruned here."""
    from eventide.sources.adapters import document_events
    return S.count_by(document_events(spark, sf), "type", "source")
