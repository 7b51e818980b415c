"""Queries over landed tables and their id index, topic folders and keyed tables (SNK-4..8, JN-1, FLT-2/5/7, SRC-1/2/5, TOP-4)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.operators import envelope as ENV
from eventide.operators import search as S
from eventide.operators.detect import statistical as ST
from eventide.operators.landing import IdIndex, find_event, land_batch
from eventide.operators.routing import transform
from eventide.operators.store import KeyedTable
from eventide.plans.detect_queries import LIVE_AS_OF, LIVE_START, SRC, fmt
from eventide.plans.flows import ORDERS_CLEAN
from eventide.plans.registry import ORACLES, query
from eventide.plans.search_queries import ROW, SE, _rows
from eventide.plans.store_queries import REQ, _topic_copies
from eventide.session import checkpoint_dir
from eventide.sources.adapters import order_records, request_bodies, stored_events
from eventide.sources.topics import read_request_file, read_topic
from eventide.streaming.state import TrailingCounts

#: Buckets of the index of these queries' tables.
BUCKETS = 16


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _landed(spark, sf) -> tuple[str, IdIndex]:
    """All stored events, landed as one batch."""
    path = _folder(spark, "landed")
    index = IdIndex.beside(spark, path, BUCKETS)
    rows = stored_events(spark, sf)
    land_batch(spark, rows, path, [F.col("seq")], "load", 0, index, drop=["seq"])
    return path, index


def _table(spark, sf) -> DataFrame:
    return spark.read.parquet(_landed(spark, sf)[0])


@query("landed_by_source", f"SELECT {ROW} FROM {SE} WHERE source = 'src-3'")
def landed_by_source(spark, sf):
    """FLT-2 over the landed table: the source reaches the scan."""
    return _rows(S.search(_table(spark, sf), source="src-3"))


@query("landed_by_status", f"SELECT {ROW} FROM {SE} WHERE status = 'FAILED'")
def landed_by_status(spark, sf):
    """FLT-5 over the landed table: the status reaches the scan."""
    return _rows(S.search(_table(spark, sf), status="FAILED"))


@query("landed_get_by_id", f"SELECT {ROW} FROM {SE} WHERE id = 'evt_42'")
def landed_get_by_id(spark, sf):
    """FLT-7 by the id index: one bucket of the index, one date of the table."""
    path, index = _landed(spark, sf)
    return _rows(find_event(spark, path, "evt_42", index))


@query("landed_page_deep", f"SELECT {ROW} FROM {SE} e ORDER BY e.received_at DESC, id LIMIT 5 OFFSET 5000")
def landed_page_deep(spark, sf):
    """TOP-4: page 1000 of 5 rows over the landed table, by the rank directory."""
    return _rows(S.page_deep(_table(spark, sf), 1000, 5, settled=20))


@query("page_10000",
       "SELECT 'evt_ord_' || CAST(o_orderkey AS VARCHAR) AS id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS received_at FROM orders e "
       "WHERE o_orderpriority <> '5-LOW' ORDER BY e.o_orderdate DESC, id LIMIT 1 OFFSET 10000")
def page_10000(spark, sf):
    """TOP-4: page 10,000 of one row over all order events, many of which share their time.

    The events are parsed once: ids and times are stored, and every step to the page reads what is stored.
    """
    rows = ENV.to_table_rows(ENV.parse_envelopes(order_records(spark, sf)).filter("parse_ok"))
    path = _folder(spark, "paged")
    rows.select("id", "received_at").write.parquet(path)
    stored = spark.read.schema("id string, received_at timestamp").parquet(path)
    return S.page_deep(stored, 10_000, 1, settled=20).select("id", fmt("received_at").alias("received_at"))


@query("land_hot_id",
       "SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'evt_hot' ELSE 'evt_ord_' || CAST(o_orderkey AS VARCHAR) END AS id, "
       "min(o_orderkey) AS \"offset\" FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1")
def land_hot_id(spark, sf):
    """SET-3 / SNK-4: a third of all copies share one id; the first copy of each id lands once."""
    env = ENV.parse_envelopes(_topic_copies(spark, sf)).filter("parse_ok")
    rows = ENV.to_table_rows(env, keep=("arrival", "offset"))
    hot = F.when(F.col("offset") % 3 == 0, "evt_hot").otherwise(F.col("id"))
    path = _folder(spark, "landed")
    land_batch(spark, rows.withColumn("id", hot).withColumn("metadata", F.col("offset").cast("string")), path,
               [F.col("arrival"), F.col("offset")], "load", 0, IdIndex.beside(spark, path, BUCKETS), drop=["arrival", "offset"])
    return spark.read.parquet(path).select("id", F.col("metadata").cast("long").alias("offset"))


@query("land_runs_indexed",
       "SELECT 'evt_ord_' || CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'RECEIVED' "
       "WHEN o_orderstatus = 'P' THEN 'FAILED' ELSE 'PROCESSED' END AS status, "
       "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS received_at FROM orders WHERE o_orderpriority <> '5-LOW'")
def land_runs_indexed(spark, sf):
    """SNK-4 / JN-1 / STR-2: two runs into one table; the second, which carries every event again, finds by the id index
    what the first has landed."""
    raw = order_records(spark, sf)
    path = _folder(spark, "landed")
    index = IdIndex.beside(spark, path, BUCKETS)
    first = ENV.to_table_rows(ENV.parse_envelopes(raw).filter("parse_ok"), keep=("offset",))
    land_batch(spark, first.filter(F.col("received_at") < F.lit("1998-01-01").cast("timestamp")), path, [F.col("offset")], "a", 0,
               index, drop=["offset"])
    again = ENV.to_table_rows(transform(raw, ORDERS_CLEAN).filter("parse_ok")).withColumn("offset", F.lit(0))
    land_batch(spark, again, path, [F.col("offset")], "b", 0, index, drop=["offset"])
    return spark.read.parquet(path).select("id", "status", fmt("received_at").alias("received_at"))


@query("baseline_upsert_buckets", ORACLES["baseline_upsert"])
def baseline_upsert_buckets(spark, sf):
    """SNK-5 as a keyed table: the older counts are written first, the fresh ones rewrite the buckets they touch."""
    t = KeyedTable(spark, _folder(spark, "baselines"), ["event_type", "event_source", "window_start"], BUCKETS)
    ev = stored_events(spark, sf)
    old = ev.filter(F.col("received_at") < F.lit("2024-01-21 00:00:00").cast("timestamp"))
    from eventide.sources.adapters import table
    value = table(spark, sf, "events").select(F.col("event_id").alias("seq"), "value")
    counted = old.join(value, "seq").groupBy(F.col("type").alias("event_type"), F.col("source").alias("event_source"),
                                             F.window("received_at", "1 day").alias("w")).agg(
        F.count_if(F.col("value") > 100).alias("event_count"))
    t.upsert(counted.select("event_type", "event_source", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                            "event_count"))
    t.upsert(ST.window_counts(ev.filter(F.col("received_at") >= F.lit("2024-01-15 00:00:00").cast("timestamp")), "1 day"))
    return t.read().select("event_type", "event_source", fmt("window_start").alias("window_start"), "event_count")


@query("volume_live_counts",
       f"SELECT event_type, {SRC} AS event_source, count(*) AS event_count FROM events "
       f"WHERE ts BETWEEN TIMESTAMP '{LIVE_START}' AND TIMESTAMP '{LIVE_AS_OF}' GROUP BY 1, 2")
def volume_live_counts(spark, sf):
    """STR-4 / FLT-9: events arrive in four batches in no order of time; the trailing day is summed from the stored counts of
    its hours."""
    ev = stored_events(spark, sf)
    counts = TrailingCounts(spark, _folder(spark, "counts"))
    for k in range(4):
        counts.add(ev.filter(F.pmod(F.xxhash64("id"), F.lit(4)) == k), "load", k)
    end = spark.sql(f"select unix_seconds(timestamp '{LIVE_AS_OF}')").first()[0]
    return counts.window(end, 86400)


@query("topic_pattern_read",
       "SELECT topic, count(*) AS records, count(DISTINCT \"partition\") AS partitions FROM (SELECT CASE WHEN o_orderkey % 2 = 0 "
       "THEN 'orders.raw' ELSE 'returns.raw' END AS topic, o_orderkey % 4 AS \"partition\" FROM orders) GROUP BY topic")
def topic_pattern_read(spark, sf):
    """SRC-1 / SRC-2: records of several topics in a topic folder, read back by a pattern that leaves internal ones out."""
    raw = order_records(spark, sf)
    topic = F.when(F.col("offset") % 2 == 0, "orders.raw").otherwise("returns.raw")
    path = _folder(spark, "topics")
    raw.withColumn("topic", topic).unionByName(raw.withColumn("topic", F.lit("__offsets"))).write.parquet(path)
    got = read_topic(spark, pattern=r"^[a-z]+\.raw$", path=path)
    return got.groupBy("topic").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("partition").alias("partitions"))


@query("request_file",
       f"SELECT role = 'system' AS malformed, role <> 'system' AND src <> '' AS valid, count(*) AS requests FROM {REQ} GROUP BY 1, 2")
def request_file(spark, sf):
    """SRC-5: request bodies written to a file, one a line, bulk-loaded and validated."""
    path = _folder(spark, "requests")
    request_bodies(spark, sf).select(F.regexp_replace("value", r"[\r\n]+", " ").alias("value")).write.text(path)
    return ENV.parse_requests(read_request_file(spark, path)).groupBy("malformed", "valid").agg(
        F.count(F.lit(1)).alias("requests"))
