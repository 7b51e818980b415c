"""The flagship query: order envelopes -> parse -> map -> route."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators.routing import route, transform
from eventide.plans.flows import ORDERS_CLEAN
from eventide.plans.registry import query
from eventide.sources.adapters import order_records


@query("flagship_route_status",
       "SELECT CASE WHEN o_orderpriority = '5-LOW' OR o_orderstatus = 'P' THEN 'events.failed' "
       "ELSE 'orders.clean' END AS topic, CASE WHEN o_orderpriority = '5-LOW' THEN 'UNPARSED' "
       "WHEN o_orderstatus = 'P' THEN 'FAILED' ELSE 'PROCESSED' END AS status, count(*) AS records "
       "FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2")
def flagship(spark, sf):
    t = transform(order_records(spark, sf), ORDERS_CLEAN)
    ok = F.col("parse_ok") & (F.col("status") != "FAILED")
    tagged = t.select(
        F.when(ok, F.lit(ORDERS_CLEAN.destination_topic)).otherwise(F.lit(ORDERS_CLEAN.dead_letter)).alias("topic"),
        F.when(F.col("parse_ok"), F.col("status")).otherwise(F.lit("UNPARSED")).alias("status"))
    return tagged.groupBy("topic", "status").agg(F.count(F.lit(1)).alias("records"))
