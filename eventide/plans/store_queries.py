"""Landing, dedup and request-validation queries (SNK-4, SET-3, JN-1, VAL-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.model import RAW_TOPIC
from eventide.operators import envelope as ENV
from eventide.operators import store as STO
from eventide.operators.routing import publish, route, transform
from eventide.operators.search import parseable
from eventide.plans.flows import ORDERS_CLEAN
from eventide.plans.registry import query
from eventide.sources.adapters import order_records, request_bodies
from eventide.sources.topics import list_topics

ORD = "(SELECT o.*, c.* FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"


def _topic_copies(spark, sf):
    """Every copy of every order event as the store sees it: the raw topic
    (arrival 0) and the routed copies (arrival 1), all sharing one id."""
    raw = order_records(spark, sf)
    routed = route(transform(raw, ORDERS_CLEAN), ORDERS_CLEAN)
    return (raw.select("topic", "value", F.lit(0).alias("arrival"), "offset")
            .unionByName(routed.select("topic", "value", F.lit(1).alias("arrival"),
                                       F.col("source_offset").alias("offset"))))


@query("land_first_wins",
       f"SELECT 'evt_ord_' || CAST(o_orderkey AS VARCHAR) AS id, 'RECEIVED' AS status FROM {ORD} "
       "WHERE o_orderpriority <> '5-LOW'")
def land_first_wins(spark, sf):
    copies = _topic_copies(spark, sf)
    env = ENV.parse_envelopes(copies).filter("parse_ok")
    rows = env.select("id", "status", "arrival", "offset")
    first = STO.dedup_first(rows, [F.col("arrival"), F.col("offset")])
    return first.select("id", "status")


@query("land_increment",
       f"SELECT 'evt_ord_' || CAST(o_orderkey AS VARCHAR) AS id, "
       "CASE WHEN o_orderstatus = 'P' THEN 'FAILED' ELSE 'PROCESSED' END AS status "
       f"FROM {ORD} WHERE o_orderpriority <> '5-LOW' AND o_orderdate >= TIMESTAMP '1995-01-01'")
def land_increment(spark, sf):
    raw = order_records(spark, sf)
    stored = ENV.to_table_rows(ENV.parse_envelopes(raw).filter("parse_ok")).filter(
        F.col("received_at") < F.lit("1995-01-01").cast("timestamp"))
    batch = transform(raw, ORDERS_CLEAN).filter("parse_ok")
    rows = ENV.to_table_rows(batch).withColumn("offset", F.lit(0))
    new = STO.land(rows, stored, [F.col("offset")])
    return new.select("id", "status")


@query("list_topics",
       f"SELECT DISTINCT topic FROM (SELECT 'orders.raw' AS topic FROM {ORD} UNION ALL "
       "SELECT CASE WHEN o_orderpriority = '5-LOW' OR o_orderstatus = 'P' THEN 'events.failed' "
       f"ELSE 'orders.clean' END FROM {ORD}) ORDER BY topic")
def list_topics_q(spark, sf):
    return list_topics(_topic_copies(spark, sf))


REQ = """(SELECT conv_id AS batch_id, turn, role,
  CASE WHEN regexp_matches(text, '^\\w') THEN regexp_extract(text, '^(\\w+)', 1) ELSE '' END AS src
  FROM conversations)"""


@query("validate_requests",
       f"SELECT batch_id, turn, role = 'system' AS malformed, "
       "role <> 'system' AND src <> '' AS valid, "
       "CASE WHEN role = 'system' THEN '' WHEN src = '' THEN 'source' ELSE '' END AS violations "
       f"FROM {REQ}")
def validate_requests(spark, sf):
    r = ENV.parse_requests(request_bodies(spark, sf))
    return r.select("batch_id", "turn", "malformed", "valid", F.array_join("violations", ",").alias("violations"))


@query("validate_batch_cap",
       "SELECT conv_id AS batch_id, count(*) AS batch_size, count(*) > 6 AS batch_rejected, "
       "CASE WHEN count(*) > 6 THEN 'Batch size ' || CAST(count(*) AS VARCHAR) || ' exceeds maximum of 6' END "
       "AS batch_error FROM conversations GROUP BY conv_id")
def validate_batch_cap(spark, sf):
    r = ENV.check_batch_size(request_bodies(spark, sf), max_batch=6)
    return r.select("batch_id", "batch_size", "batch_rejected", "batch_error").distinct()


@query("accepted_envelopes",
       f"SELECT batch_id, turn, role AS type, src AS source, 'RECEIVED' AS status FROM {REQ} "
       "WHERE role <> 'system' AND src <> '' AND batch_id IN "
       "(SELECT conv_id FROM conversations GROUP BY conv_id HAVING count(*) <= 6)")
def accepted_envelopes(spark, sf):
    """VAL-1..3 then ENV-1: only valid requests of accepted batches become envelopes."""
    r = ENV.check_batch_size(ENV.parse_requests(request_bodies(spark, sf)), max_batch=6)
    ok = r.filter(F.col("valid") & ~F.col("batch_rejected"))
    env = ENV.build_envelopes(ok, keep=("batch_id", "turn"))
    return env.select("batch_id", "turn", "type", "source", "status")


@query("validate_batches",
       "SELECT batch_id, count(*) AS batch_size, count(*) FILTER (WHERE role = 'system' OR src = '') AS invalid_requests, "
       "count(*) FILTER (WHERE role = 'system' OR src = '') > 0 AS batch_invalid "
       f"FROM {REQ} GROUP BY batch_id")
def validate_batches(spark, sf):
    """VAL-1/3: a batch goes in whole or not at all."""
    r = ENV.check_batch_requests(ENV.parse_requests(request_bodies(spark, sf)))
    return r.groupBy("batch_id", "invalid_requests", "batch_invalid").agg(
        F.count(F.lit(1)).alias("batch_size")).select("batch_id", "batch_size", "invalid_requests", "batch_invalid")


@query("publish_raw",
       f"SELECT '{RAW_TOPIC}' AS topic, 'evt_ord_' || CAST(o_orderkey AS VARCHAR) AS key, 'order.created' AS type, "
       "CAST(epoch(o_orderdate) AS BIGINT) AS seconds, o_orderkey AS order_id, o_orderstatus AS order_status, "
       f"false AS has_error FROM {ORD} WHERE o_orderpriority <> '5-LOW'")
def publish_raw(spark, sf):
    """SNK-1 + ENV-3: envelopes on the raw topic, keyed by id; members read back from the published text."""
    out = publish(ENV.parse_envelopes(order_records(spark, sf)).filter("parse_ok"))
    v = F.parse_json("value")
    return out.select("topic", "key", F.try_variant_get(v, "$.type", "string").alias("type"),
                      F.try_variant_get(v, "$.timestamp", "decimal(20,6)").cast("long").alias("seconds"),
                      F.try_variant_get(v, "$.payload.orderId", "bigint").alias("order_id"),
                      F.try_variant_get(v, "$.payload.status", "string").alias("order_status"),
                      F.try_variant_get(v, "$.errorMessage", "variant").isNotNull().alias("has_error"))


@query("parseable_bodies", "SELECT conv_id AS batch_id, turn FROM conversations WHERE role <> 'system'")
def parseable_bodies(spark, sf):
    """FLT-10: texts that are not JSON are left out."""
    return parseable(request_bodies(spark, sf), "value").select("batch_id", "turn")


@query("existing_ids",
       "SELECT 'evt_ord_' || CAST(o_orderkey AS VARCHAR) AS id FROM orders "
       "WHERE o_orderpriority <> '5-LOW' AND o_orderdate < TIMESTAMP '1998-01-01'")
def existing_ids(spark, sf):
    """FLT-11: ids of the topic that the table holds already."""
    raw = order_records(spark, sf)
    stored = ENV.to_table_rows(ENV.parse_envelopes(raw).filter("parse_ok")).filter(
        F.col("received_at") < F.lit("1998-01-01").cast("timestamp"))
    return STO.exists(raw.select(F.col("key").alias("id")), stored)


@query("land_resumed",
       "SELECT 'evt_ord_' || CAST(o_orderkey AS VARCHAR) AS id, "
       "CASE WHEN o_orderstatus = 'P' THEN 'FAILED' ELSE 'PROCESSED' END AS status "
       "FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderdate >= TIMESTAMP '1998-01-01'")
def land_resumed(spark, sf):
    """SNK-4 / JN-1: a second run lands only the ids that the first one left out, whatever date a copy carries."""
    raw = order_records(spark, sf)
    stored = ENV.to_table_rows(ENV.parse_envelopes(raw).filter("parse_ok")).filter(
        F.col("received_at") < F.lit("1998-01-01").cast("timestamp"))
    rows = ENV.to_table_rows(transform(raw, ORDERS_CLEAN).filter("parse_ok"))
    again = rows.withColumns({"received_at": F.col("received_at") + F.expr("INTERVAL 1 DAY"), "offset": F.lit(1)})
    new = STO.land(rows.withColumn("offset", F.lit(0)).unionByName(again), stored, [F.col("offset")])
    return new.select("id", "status")


HOSTILE = {0: "7", 1: "-1", 2: "2", 3: '"NOPE"'}


@query("envelope_parse_hostile",
       "SELECT o_orderkey AS \"offset\", o_orderkey % 4 = 2 AS status_ok, o_orderkey % 3 = 0 AS time_ok, "
       "o_orderkey % 4 = 2 AND o_orderkey % 3 = 0 AS parse_ok FROM orders")
def envelope_parse_hostile(spark, sf):
    """ENV-2 / RT-3: statuses out of range and times out of reach are unreadable, never an error of the job."""
    o = order_records(spark, sf).select("offset")
    status = F.element_at(F.create_map(*[F.lit(x) for kv in HOSTILE.items() for x in kv]),
                          (F.col("offset") % 4).cast("int"))
    time = F.when(F.col("offset") % 3 == 0, "1700000000").when(F.col("offset") % 3 == 1, "99999999999999999999") \
        .otherwise("1e25")

    def text(s, t):
        return F.format_string('{"id":"x","status":%s,"timestamp":%s,"payload":{}}', s, t)

    def ok(value):
        return ENV.parse_envelopes(o.select("offset", value.alias("value"))).select("offset", "parse_ok")
    good_status, good_time = F.lit('"RECEIVED"'), F.lit("1700000000")
    three = (ok(text(status, good_time)).withColumnRenamed("parse_ok", "status_ok")
             .join(ok(text(good_status, time)).withColumnRenamed("parse_ok", "time_ok"), "offset")
             .join(ok(text(status, time)), "offset"))
    return three.select("offset", "status_ok", "time_ok", "parse_ok")
