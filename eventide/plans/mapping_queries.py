"""Mapping, conversion and routing queries (MAP-*, CONV-*, RT-*, ENV-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.model import m
from eventide.operators.envelope import parse_envelopes
from eventide.operators.mapping import compile_mappings
from eventide.operators.routing import dead_letter_rows, fan_out, route, transform
from eventide.plans.flows import ALL_FLOWS, ORDERS_AUDIT, ORDERS_CLEAN
from eventide.plans.registry import query
from eventide.sources.adapters import order_records, table


def vget(col, path, typ):
    return F.try_variant_get(F.col(col), path, typ)


# --------------------------------------------------------------------------
# Derived payload sources for conversions
# --------------------------------------------------------------------------
def line_payloads(spark, sf):
    li = table(spark, sf, "lineitem")
    payload = F.to_json(F.struct(
        F.col("l_orderkey").alias("order"), F.col("l_linenumber").alias("line"),
        F.col("l_quantity").cast("string").alias("qty"), F.col("l_extendedprice").alias("price"),
        F.col("l_discount").cast("string").alias("discountText"),
        F.col("l_partkey").cast("string").alias("partText"),
        F.col("l_returnflag").alias("flag"), (F.col("l_linestatus") == "O").alias("open"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("shipped"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shippedLocal")))
    return li.select("l_orderkey", "l_linenumber", F.parse_json(payload).alias("payload"))


def part_payloads(spark, sf):
    p = table(spark, sf, "part")
    payload = F.to_json(F.struct(F.col("p_partkey").alias("key"), F.col("p_name").alias("name"),
                                 F.col("p_brand").alias("brand"), F.col("p_type").alias("kind")))
    return p.select("p_partkey", F.parse_json(payload).alias("payload"))


LI = "lineitem"


@query("convert_integer",
       f"SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice) AS INTEGER) AS price_int, "
       f"l_linenumber AS line_int, CAST(NULL AS INTEGER) AS qty_int, "
       f"'For input string: \"' || CAST(l_quantity AS VARCHAR) || '\"' AS map_error FROM {LI}")
def convert_integer(spark, sf):
    out = compile_mappings(line_payloads(spark, sf), [
        m("price", "p", "TO_INTEGER"), m("line", "l", "TO_INTEGER"), m("qty", "q", "TO_INTEGER")])
    return out.select("l_orderkey", "l_linenumber", vget("mapped", "$.p", "int").alias("price_int"),
                      vget("mapped", "$.l", "int").alias("line_int"),
                      vget("mapped", "$.q", "int").alias("qty_int"), "map_error")


@query("convert_number_text",
       "WITH t AS (SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS DOUBLE) AS VARCHAR) AS q, "
       f"CAST(CAST(l_extendedprice AS DOUBLE) AS VARCHAR) AS p, CAST(l_partkey AS VARCHAR) AS k FROM {LI}) "
       "SELECT l_orderkey, l_linenumber, q AS qty_text, p AS price_text, k AS part_text, "
       "substr(q, 1, 1) || repeat('*', length(q) - 2) || right(q, 1) AS qty_mask, "
       "'{\"d\":' || q || ',\"f\":' || q || ',\"p\":' || p || ',\"q\":' || q || '}' AS kept FROM t")
def convert_number_text(spark, sf):
    """CONV-0/1/9: numbers with a point, whole ones among them, keep their form as text, masked and unchanged."""
    li = table(spark, sf, "lineitem")
    num = [F.col(c).cast("double").cast("string") for c in ("l_quantity", "l_extendedprice")]
    text = F.format_string('{"qty":%s,"price":%s,"part":%d,"in":{"f":%s}}', *num, F.col("l_partkey"), num[0])
    src = li.select("l_orderkey", "l_linenumber", F.parse_json(text).alias("payload"))
    out = compile_mappings(src, [m("qty", "t.q", "TO_STRING"), m("price", "t.p", "TO_STRING"), m("part", "t.k", "TO_STRING"),
                                 m("qty", "t.m", "MASK")])
    out = out.withColumnRenamed("mapped", "text").drop("map_error")
    out = compile_mappings(out, [m("qty", "q"), m("price", "p", "NONE"), m("qty", "d", default="0"), m("in", "", "FLATTEN")])
    return out.select("l_orderkey", "l_linenumber", *[vget("text", f"$.t.{c}", "string").alias(a) for c, a in (
        ("q", "qty_text"), ("p", "price_text"), ("k", "part_text"), ("m", "qty_mask"))], F.to_json("mapped").alias("kept"))


@query("convert_long",
       f"SELECT l_orderkey, l_linenumber, l_orderkey AS order_long, l_partkey AS part_long, "
       f"CAST(trunc(l_extendedprice) AS BIGINT) AS price_long FROM {LI}")
def convert_long(spark, sf):
    out = compile_mappings(line_payloads(spark, sf), [
        m("order", "o", "TO_LONG"), m("partText", "p", "TO_LONG"), m("price", "x", "TO_LONG")])
    return out.select("l_orderkey", "l_linenumber", vget("mapped", "$.o", "bigint").alias("order_long"),
                      vget("mapped", "$.p", "bigint").alias("part_long"),
                      vget("mapped", "$.x", "bigint").alias("price_long"))


@query("convert_wrap",
       "WITH t AS (SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS HUGEINT) * 1000000007 + l_linenumber AS i, "
       "CAST(l_partkey AS HUGEINT) * 10000000000000000007 AS b FROM lineitem), "
       "w AS (SELECT *, ((i % 4294967296) + 4294967296) % 4294967296 AS r32, "
       "b % 18446744073709551616 AS r64 FROM t) "
       "SELECT l_orderkey, l_linenumber, "
       "CAST(CASE WHEN r32 >= 2147483648 THEN r32 - 4294967296 ELSE r32 END AS INTEGER) AS low_int, "
       "CAST(CASE WHEN r64 >= 9223372036854775808 THEN r64 - 18446744073709551616 ELSE r64 END AS BIGINT) AS low_long, "
       "CAST(CASE WHEN l_linenumber % 2 = 0 THEN -2147483648 ELSE 2147483647 END AS INTEGER) AS end_int, "
       "CAST(CASE WHEN l_linenumber % 2 = 0 THEN -9223372036854775808 ELSE 9223372036854775807 END AS BIGINT) AS end_long "
       "FROM w")
def convert_wrap(spark, sf):
    """CONV-2/3: whole numbers beyond the type keep their low bits, numbers with a point stop at its ends."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.parse_json(F.format_string(
        '{"i":%s,"b":%s,"f":%s}',
        (F.col("l_orderkey").cast("decimal(20,0)") * 1000000007 + F.col("l_linenumber")).cast("decimal(38,0)").cast("string"),
        (F.col("l_partkey").cast("decimal(18,0)") * F.lit("10000000000000000007").cast("decimal(20,0)")).cast("string"),
        F.when(F.col("l_linenumber") % 2 == 0, "-7.5e30").otherwise("7.5e30"))).alias("payload"))
    out = compile_mappings(rows, [m("i", "i", "TO_INTEGER"), m("b", "b", "TO_LONG"),
                                  m("f", "fi", "TO_INTEGER"), m("f", "fl", "TO_LONG")])
    return out.select("l_orderkey", "l_linenumber", vget("mapped", "$.i", "int").alias("low_int"),
                      vget("mapped", "$.b", "bigint").alias("low_long"), vget("mapped", "$.fi", "int").alias("end_int"),
                      vget("mapped", "$.fl", "bigint").alias("end_long"))


@query("convert_double",
       f"SELECT l_orderkey, l_linenumber, l_quantity AS qty, round(l_discount, 4) AS discount, "
       f"round(l_extendedprice, 4) AS price, 'For input string: \"' || l_returnflag || '\"' AS map_error FROM {LI}")
def convert_double(spark, sf):
    out = compile_mappings(line_payloads(spark, sf), [
        m("qty", "q", "TO_DOUBLE"), m("discountText", "d", "TO_DOUBLE"), m("price", "p", "TO_DOUBLE"),
        m("flag", "f", "TO_DOUBLE")])
    return out.select("l_orderkey", "l_linenumber", vget("mapped", "$.q", "double").alias("qty"),
                      F.round(vget("mapped", "$.d", "double"), 4).alias("discount"),
                      F.round(vget("mapped", "$.p", "double"), 4).alias("price"), "map_error")


@query("convert_boolean",
       f"SELECT l_orderkey, l_linenumber, l_linestatus = 'O' AS is_open, false AS flag_bool, "
       f"true AS default_bool FROM {LI}")
def convert_boolean(spark, sf):
    out = compile_mappings(line_payloads(spark, sf), [
        m("open", "o", "TO_BOOLEAN"), m("flag", "f", "TO_BOOLEAN"),
        m("missing", "d", "TO_BOOLEAN", default=" True ")])
    return out.select("l_orderkey", "l_linenumber", vget("mapped", "$.o", "boolean").alias("is_open"),
                      vget("mapped", "$.f", "boolean").alias("flag_bool"),
                      vget("mapped", "$.d", "boolean").alias("default_bool"))


@query("convert_string",
       f"SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS VARCHAR) AS line_text, "
       f"CASE WHEN l_linestatus = 'O' THEN 'true' ELSE 'false' END AS open_text, "
       f"CAST(l_quantity AS VARCHAR) AS qty_text FROM {LI}")
def convert_string(spark, sf):
    out = compile_mappings(line_payloads(spark, sf), [
        m("line", "l", "TO_STRING"), m("open", "o", "TO_STRING"), m("qty", "q", "TO_STRING")])
    return out.select("l_orderkey", "l_linenumber", vget("mapped", "$.l", "string").alias("line_text"),
                      vget("mapped", "$.o", "string").alias("open_text"),
                      vget("mapped", "$.q", "string").alias("qty_text"))


@query("convert_upper_lower",
       "SELECT p_partkey, upper(p_name) AS name_upper, lower(p_type) AS kind_lower, "
       "lower(p_brand) AS brand_lower FROM part")
def convert_upper_lower(spark, sf):
    out = compile_mappings(part_payloads(spark, sf), [
        m("name", "n", "TO_UPPER"), m("kind", "k", "TO_LOWER"), m("brand", "b", "TO_LOWER")])
    return out.select("p_partkey", vget("mapped", "$.n", "string").alias("name_upper"),
                      vget("mapped", "$.k", "string").alias("kind_lower"),
                      vget("mapped", "$.b", "string").alias("brand_lower"))


@query("convert_mask",
       "SELECT p_partkey, CASE WHEN length(p_name) <= 2 THEN '**' ELSE left(p_name, 1) || "
       "repeat('*', length(p_name) - 2) || right(p_name, 1) END AS name_masked, "
       "left(p_brand, 1) || repeat('*', length(p_brand) - 2) || right(p_brand, 1) AS brand_masked, "
       "CASE WHEN length(CAST(p_partkey AS VARCHAR)) <= 2 THEN '**' ELSE left(CAST(p_partkey AS VARCHAR), 1) || "
       "repeat('*', length(CAST(p_partkey AS VARCHAR)) - 2) || right(CAST(p_partkey AS VARCHAR), 1) END "
       "AS key_masked FROM part")
def convert_mask(spark, sf):
    out = compile_mappings(part_payloads(spark, sf), [
        m("name", "n", "MASK"), m("brand", "b", "MASK"), m("key", "k", "MASK")])
    return out.select("p_partkey", vget("mapped", "$.n", "string").alias("name_masked"),
                      vget("mapped", "$.b", "string").alias("brand_masked"),
                      vget("mapped", "$.k", "string").alias("key_masked"))


@query("convert_timestamp_valid",
       f"SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') || 'Z' AS shipped, "
       f"true AS local_replaced FROM {LI}")
def convert_timestamp_valid(spark, sf):
    out = compile_mappings(line_payloads(spark, sf), [
        m("shipped", "s", "TO_TIMESTAMP"), m("shippedLocal", "t", "TO_TIMESTAMP")])
    local = vget("mapped", "$.t", "string")
    src_local = vget("payload", "$.shippedLocal", "string")
    return out.select("l_orderkey", "l_linenumber", vget("mapped", "$.s", "string").alias("shipped"),
                      (local != src_local).alias("local_replaced"))


# --------------------------------------------------------------------------
# Order envelopes through flows
# --------------------------------------------------------------------------
ORD = """(SELECT o.*, c.* FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"""
MASKED_NAME = ("CASE WHEN length(c_name) <= 2 THEN '**' ELSE left(c_name, 1) || "
               "repeat('*', length(c_name) - 2) || right(c_name, 1) END")


@query("map_orders",
       f"SELECT 'evt_ord_' || CAST(o_orderkey AS VARCHAR) AS id, o_orderkey AS order_id, "
       f"round(o_totalprice, 4) AS amount, lower(o_orderstatus) AS status, "
       f"CAST(c_custkey AS VARCHAR) AS customer_id, {MASKED_NAME} AS customer_name, "
       f"lower(c_mktsegment) AS segment, CAST(trunc(c_acctbal) AS INTEGER) AS balance, "
       f"CAST(c_nationkey AS BIGINT) AS nation_code, 'USD' AS currency, false AS has_coupon, "
       f"false AS has_priority, true AS has_processed_at, true AS has_trace "
       f"FROM {ORD} WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'")
def map_orders(spark, sf):
    t = transform(order_records(spark, sf), ORDERS_CLEAN)
    ok = t.filter(F.col("parse_ok") & (F.col("status") == "PROCESSED"))
    p = "payload"
    return ok.select(
        "id", vget(p, "$.order.id", "bigint").alias("order_id"),
        F.round(vget(p, "$.order.amount", "double"), 4).alias("amount"),
        vget(p, "$.order.status", "string").alias("status"),
        vget(p, "$.customer.id", "string").alias("customer_id"),
        vget(p, "$.customer.name", "string").alias("customer_name"),
        vget(p, "$.customer.segment", "string").alias("segment"),
        vget(p, "$.customer.balance", "int").alias("balance"),
        vget(p, "$.customer.nationCode", "bigint").alias("nation_code"),
        vget(p, "$.currency", "string").alias("currency"),
        vget(p, "$.coupon", "variant").isNotNull().alias("has_coupon"),
        vget(p, "$.priority", "variant").isNotNull().alias("has_priority"),
        (F.length(vget(p, "$.meta.processedAt", "string")) > 0).alias("has_processed_at"),
        (F.length(vget(p, "$.meta.traceId", "string")) == 36).alias("has_trace"))


@query("route_counts",
       f"SELECT CASE WHEN o_orderpriority = '5-LOW' OR o_orderstatus = 'P' THEN 'events.failed' "
       f"ELSE 'orders.clean' END AS topic, count(*) AS records FROM {ORD} GROUP BY 1")
def route_counts(spark, sf):
    out = route(transform(order_records(spark, sf), ORDERS_CLEAN), ORDERS_CLEAN)
    return out.groupBy("topic").agg(F.count(F.lit(1)).alias("records"))


@query("dead_letter_messages",
       f"SELECT 'evt_ord_' || CAST(o_orderkey AS VARCHAR) AS id, 'FAILED' AS status, "
       f"'[orders-clean] For input string: \"pending\"' AS error_message, "
       f"o_orderkey AS kept_order_id, 'pending' AS kept_total "
       f"FROM {ORD} WHERE o_orderstatus = 'P' AND o_orderpriority <> '5-LOW'")
def dead_letter_messages(spark, sf):
    t = transform(order_records(spark, sf), ORDERS_CLEAN)
    f = t.filter(F.col("parse_ok") & (F.col("status") == "FAILED"))
    return f.select("id", "status", "error_message",
                    vget("payload", "$.orderId", "bigint").alias("kept_order_id"),
                    vget("payload", "$.total", "string").alias("kept_total"))


@query("dead_letter_unparseable",
       f"SELECT 'evt_ord_' || CAST(o_orderkey AS VARCHAR) AS key, 'events.failed' AS topic "
       f"FROM {ORD} WHERE o_orderpriority = '5-LOW'")
def dead_letter_unparseable(spark, sf):
    t = transform(order_records(spark, sf), ORDERS_CLEAN)
    out = route(t, ORDERS_CLEAN)
    # unparseable records reach the dead letter with their text unchanged (RT-3)
    bad = out.filter(~F.col("ok") & F.try_variant_get(F.parse_json("value"), "$.priority", "string").isNotNull())
    return bad.select("key", "topic")


@query("dead_letter_table",
       f"SELECT 'evt_ord_' || CAST(o_orderkey AS VARCHAR) AS id, 'orders-clean' AS pipeline_name, "
       f"'order.created' AS event_type, 'orders-db' AS event_source, 0 AS retry_count "
       f"FROM {ORD} WHERE o_orderstatus = 'P' AND o_orderpriority <> '5-LOW'")
def dead_letter_table(spark, sf):
    t = transform(order_records(spark, sf), ORDERS_CLEAN)
    return dead_letter_rows(t.filter(F.col("parse_ok"))).select(
        "id", "pipeline_name", "event_type", "event_source", "retry_count")


@query("map_flatten",
       f"SELECT CAST(o_orderkey AS VARCHAR) AS id, c_custkey AS root_id_check, c_name AS name, "
       f"c_mktsegment AS segment, upper(o_orderpriority) AS priority, "
       f"round(c_acctbal, 4) AS balance FROM {ORD} WHERE o_orderpriority <> '5-LOW'")
def map_flatten(spark, sf):
    t = transform(order_records(spark, sf), ORDERS_AUDIT)
    ok = t.filter(F.col("parse_ok") & (F.col("status") == "PROCESSED"))
    p = "payload"
    # customer.id flattened to the root overwrites the earlier id mapping
    return ok.select(vget(p, "$.id", "string").alias("root_id_text"),
                     vget(p, "$.id", "bigint").alias("root_id_check"),
                     vget(p, "$.name", "string").alias("name"),
                     vget(p, "$.segment", "string").alias("segment"),
                     vget(p, "$.priority", "string").alias("priority"),
                     F.round(vget(p, "$.balance", "double"), 4).alias("balance"),
                     F.col("id")).select(
        F.regexp_replace("id", "^evt_ord_", "").alias("id"), "root_id_check", "name", "segment",
        "priority", "balance")


@query("map_flatten_scalars",
       "SELECT o_orderkey AS order_id, o_orderstatus AS status, o_orderpriority AS label, "
       "CASE WHEN o_orderstatus = 'P' THEN 'pending' END AS total FROM orders WHERE o_orderpriority <> '5-LOW'")
def map_flatten_scalars(spark, sf):
    """MAP-10: FLATTEN of numbers, texts and arrays passes them unchanged."""
    recs = parse_envelopes(order_records(spark, sf)).filter("parse_ok")
    out = compile_mappings(recs, [m("orderId", "n", "FLATTEN"), m("status", "a.status", "FLATTEN"), m("tags", "tags", "FLATTEN"),
                                  m("total", "total", "FLATTEN")])
    p = "mapped"
    total = vget(p, "$.total", "string")
    return out.select(vget(p, "$.n", "bigint").alias("order_id"), vget(p, "$.a.status", "string").alias("status"),
                      vget(p, "$.tags[0].label", "string").alias("label"), F.when(total == "pending", total).alias("total"))


@query("map_flatten_nested",
       f"SELECT o_orderkey AS order_id, c_name AS cust_name, c_nationkey AS cust_nation, "
       f"o_orderstatus AS status_kept, 'x' AS overwritten FROM {ORD} WHERE o_orderpriority <> '5-LOW'")
def map_flatten_nested(spark, sf):
    recs = parse_envelopes(order_records(spark, sf)).filter("parse_ok")
    out = compile_mappings(recs, [
        m("orderId", "order_id"),
        m("status", "cust", default="n/a"),          # value first ...
        m("customer", "cust", "FLATTEN"),            # ... replaced by an object
        m("status", "cust.status_kept"),             # written into that object
        m("priority", "tag"), m("missing", "tag", default="x"),  # later present write wins
    ])
    p = "mapped"
    return out.select(vget(p, "$.order_id", "bigint").alias("order_id"),
                      vget(p, "$.cust.name", "string").alias("cust_name"),
                      vget(p, "$.cust.nation", "int").alias("cust_nation"),
                      vget(p, "$.cust.status_kept", "string").alias("status_kept"),
                      vget(p, "$.tag", "string").alias("overwritten"))


@query("map_conflict_order",
       f"SELECT o_orderkey AS order_id, o_orderstatus AS a_value, false AS b_is_object, "
       f"o_orderpriority AS c_inner FROM {ORD} WHERE o_orderpriority <> '5-LOW'")
def map_conflict_order(spark, sf):
    recs = parse_envelopes(order_records(spark, sf)).filter("parse_ok")
    out = compile_mappings(recs, [
        m("orderId", "order_id"),
        m("priority", "a.inner"), m("status", "a"),        # object then value: value wins
        m("status", "b.x"), m("customer.segment", "b"),     # value replaces the object
        m("status", "c"), m("priority", "c.inner"),         # value replaced by an object
    ])
    p = "mapped"
    return out.select(vget(p, "$.order_id", "bigint").alias("order_id"),
                      vget(p, "$.a", "string").alias("a_value"),
                      F.substring(F.to_json(vget(p, "$.b", "variant")), 1, 1).eqNullSafe("{").alias("b_is_object"),
                      vget(p, "$.c.inner", "string").alias("c_inner"))


@query("fanout_counts",
       f"SELECT 'orders-clean' AS flow, CASE WHEN o_orderpriority = '5-LOW' OR o_orderstatus = 'P' "
       f"THEN 'events.failed' ELSE 'orders.clean' END AS topic, count(*) AS records FROM {ORD} GROUP BY 1, 2 "
       f"UNION ALL SELECT 'orders-audit' AS flow, CASE WHEN o_orderpriority = '5-LOW' "
       f"THEN 'orders.audit.failed' ELSE 'orders.audit' END AS topic, count(*) AS records FROM {ORD} GROUP BY 1, 2")
def fanout_counts(spark, sf):
    """RT-5 + TOP-5: latest runnable version of each definition, each reading its topic."""
    from eventide.operators.definitions import definitions_table, runnable, to_flows
    flows = to_flows(runnable(definitions_table(spark, ALL_FLOWS)))
    out = fan_out(order_records(spark, sf), flows)
    return out.groupBy("flow", "topic").agg(F.count(F.lit(1)).alias("records"))


@query("envelope_parse",
       f"SELECT 'evt_ord_' || CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority <> '5-LOW' AS parse_ok, "
       f"CASE WHEN o_orderpriority <> '5-LOW' THEN 'RECEIVED' END AS status, "
       f"CASE WHEN o_orderpriority <> '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS ts "
       f"FROM {ORD}")
def envelope_parse(spark, sf):
    env = parse_envelopes(order_records(spark, sf))
    return env.select(F.col("key").alias("id"), "parse_ok",
                      F.when(F.col("parse_ok"), F.col("status")).alias("status"),
                      F.when(F.col("parse_ok"), F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")).alias("ts"))


SAMPLE = f"""(SELECT * FROM (SELECT *, row_number() OVER (ORDER BY part, o_orderkey) AS k FROM
  (SELECT *, o_orderkey % 4 AS part, row_number() OVER (PARTITION BY o_orderkey % 4 ORDER BY o_orderkey DESC) AS rn
   FROM {ORD}) WHERE rn <= 10) WHERE k <= 10)"""


@query("map_preview",
       f"SELECT o_orderkey AS order_id, lower(o_orderstatus) AS status, {MASKED_NAME} AS customer_name, "
       f"CASE WHEN o_orderstatus = 'P' THEN '[orders-clean] For input string: \"pending\"' END AS map_error "
       f"FROM {SAMPLE}")
def map_preview(spark, sf):
    """MAP-11: a definition's mappings over the topic's tail sample, nothing published."""
    from eventide.functions.json import unwrap_payload
    from eventide.operators.mapping import preview
    from eventide.sources.topics import tail_sample
    s = tail_sample(order_records(spark, sf), 10)
    p = s.select(unwrap_payload(F.parse_json("value")).alias("payload"))
    out = preview(p, ORDERS_CLEAN.mappings)
    return out.select(vget("mapped", "$.order.id", "bigint").alias("order_id"),
                      vget("mapped", "$.order.status", "string").alias("status"),
                      vget("mapped", "$.customer.name", "string").alias("customer_name"),
                      F.when(F.col("map_error").isNotNull(),
                             F.concat(F.lit(f"[{ORDERS_CLEAN.name}] "), F.col("map_error"))).alias("map_error"))
