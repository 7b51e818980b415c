"""Discovery, drift, volume, embedding and alert queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from eventide.functions.json import unwrap_payload
from eventide.functions.text import schema_hash
from eventide.operators import alerts as A
from eventide.operators.detect import drift as D
from eventide.operators.detect import embedding as EMB
from eventide.operators.detect import statistical as ST
from eventide.operators.discovery import discover, field_sets
from eventide.operators.sampling import latest_n
from eventide.plans.registry import query
from eventide.session import checkpoint_dir
from eventide.sources.adapters import (document_events, event_vectors, order_records, shaped_events,
                                       stored_events)
from eventide.sources.topics import discovery_sample, tail_sample

TS = "yyyy-MM-dd HH:mm:ss"


def fmt(c):
    return F.date_format(c, TS)


# --------------------------------------------------------------------------
# Discovery
# --------------------------------------------------------------------------
ORD = "(SELECT o.*, c.* FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"
FIRST_TOTAL = ("(SELECT CASE WHEN o_orderstatus = 'P' THEN 'string' ELSE 'double' END FROM orders "
               "ORDER BY o_orderkey LIMIT 1)")
ORDER_PATHS = f"""
SELECT 'orderId' AS path, 'integer' AS type, count(*) AS occurrences FROM {{src}}
UNION ALL SELECT 'total', {{first_total}}, count(*) FROM {{src}}
UNION ALL SELECT 'status', 'string', count(*) FROM {{src}}
UNION ALL SELECT 'priority', 'string', count(*) FROM {{src}}
UNION ALL SELECT 'customer', 'object', count(*) FROM {{src}}
UNION ALL SELECT 'customer.id', 'integer', count(c_custkey) FROM {{src}}
UNION ALL SELECT 'customer.name', 'string', count(c_name) FROM {{src}}
UNION ALL SELECT 'customer.segment', 'string', count(c_mktsegment) FROM {{src}}
UNION ALL SELECT 'customer.balance', 'double', count(c_acctbal) FROM {{src}}
UNION ALL SELECT 'customer.nation', 'integer', count(c_nationkey) FROM {{src}}
UNION ALL SELECT 'tags', 'array', count(*) FROM {{src}}
UNION ALL SELECT 'tags[*].label', 'string', count(*) FROM {{src}}
UNION ALL SELECT 'tags[*].code', 'string', count(*) FROM {{src}}
"""


@query("discover_orders", ORDER_PATHS.format(src=ORD, first_total=FIRST_TOTAL))
def discover_orders(spark, sf):
    recs = order_records(spark, sf)
    payloads = recs.select(F.col("offset").alias("seq"), unwrap_payload(F.parse_json("value")).alias("payload"))
    return discover(payloads)


SAMPLE_SQL = f"""(SELECT * FROM (SELECT *, row_number() OVER (ORDER BY part, o_orderkey) AS k FROM
  (SELECT *, o_orderkey % 4 AS part, row_number() OVER (PARTITION BY o_orderkey % 4 ORDER BY o_orderkey DESC) AS rn
   FROM {ORD}) WHERE rn <= 10) WHERE k <= 10)"""
FIRST_SAMPLE_TOTAL = (f"(SELECT CASE WHEN o_orderstatus = 'P' THEN 'string' ELSE 'double' END FROM {SAMPLE_SQL} "
                      "ORDER BY part, o_orderkey LIMIT 1)")


@query("discover_topic_sample", ORDER_PATHS.format(src=SAMPLE_SQL, first_total=FIRST_SAMPLE_TOTAL))
def discover_topic_sample(spark, sf):
    """DISC-4: 10 tail samples of the topic, payload unwrapped (FN-4)."""
    s = discovery_sample(order_records(spark, sf))
    # first seen = poll order (partition, then offset)
    payloads = s.select((F.col("partition").cast("long") * F.lit(1 << 40) + F.col("offset")).alias("seq"),
                        unwrap_payload(F.parse_json("value")).alias("payload"))
    return discover(payloads)


@query("tail_sample",
       "SELECT CAST(part AS INTEGER) AS partition, o_orderkey AS \"offset\" FROM (SELECT *, row_number() OVER (ORDER BY part, o_orderkey) AS k "
       f"FROM (SELECT *, o_orderkey % 4 AS part, row_number() OVER (PARTITION BY o_orderkey % 4 ORDER BY o_orderkey DESC) "
       f"AS rn FROM {ORD}) WHERE rn <= 5) WHERE k <= 5")
def tail_sample_q(spark, sf):
    return tail_sample(order_records(spark, sf), 5).select("partition", "offset")


@query("discover_documents",
       "SELECT 'docId' AS path, 'integer' AS type, count(*) AS occurrences FROM documents "
       "UNION ALL SELECT 'meta', 'object', count(*) FROM documents "
       "UNION ALL SELECT 'meta.lang', 'string', count(lang) FROM documents "
       "UNION ALL SELECT 'meta.chars', 'integer', count(n_chars) FROM documents "
       "UNION ALL SELECT 'text', 'string', count(text) FROM documents")
def discover_documents(spark, sf):
    d = document_events(spark, sf)
    return discover(d.select("seq", F.parse_json("payload").alias("payload")))


SHAPED = """(SELECT 'evt_' || CAST(event_id AS VARCHAR) AS id, event_type AS type, ts AS stored_at,
  list_concat(['k'], CASE WHEN value > 100 THEN ['v'] ELSE [] END,
              CASE WHEN user_id < 5 THEN ['u', 'u.id'] ELSE [] END) AS paths FROM events)"""


@query("discover_shaped",
       f"SELECT path, CASE WHEN path = 'v' THEN 'double' WHEN path = 'u' THEN 'object' ELSE 'integer' END AS type, "
       f"count(*) AS occurrences FROM (SELECT unnest(paths) AS path FROM {SHAPED}) GROUP BY path")
def discover_shaped(spark, sf):
    e = shaped_events(spark, sf)
    return discover(e.select("seq", F.parse_json("payload").alias("payload")))


@query("latest_per_type",
       "SELECT type, id FROM (SELECT 'evt_' || CAST(event_id AS VARCHAR) AS id, event_type AS type, "
       "row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, 'evt_' || CAST(event_id AS VARCHAR) DESC) AS rn "
       "FROM events) WHERE rn <= 20")
def latest_per_type(spark, sf):
    se = stored_events(spark, sf)
    return latest_n(se, ["type"], [F.col("stored_at").desc(), F.col("id").desc()], 20).select("type", "id")


@query("schema_hash",
       "SELECT event_type AS type, substr(sha256('[k]'), 1, 16) AS schema_hash, 1 AS n_fields "
       "FROM events GROUP BY event_type")
def schema_hash_q(spark, sf):
    se = stored_events(spark, sf)
    s = latest_n(se, ["type"], [F.col("stored_at").desc(), F.col("id").desc()], 20)
    fs = field_sets(s.withColumn("payload", F.try_parse_json("payload")), ["type"])
    return fs.select("type", schema_hash(F.col("field_names")).alias("schema_hash"),
                     F.size("field_names").alias("n_fields"))


DRIFT_SQL = f"""
WITH s AS (SELECT type, stored_at, id, paths, date_trunc('day', stored_at) + INTERVAL 1 DAY AS check_at,
             row_number() OVER (PARTITION BY type, date_trunc('day', stored_at) ORDER BY stored_at DESC, id DESC) AS rn
           FROM {SHAPED}),
c AS (SELECT type, check_at, count(*) AS sample_count,
             list_sort(list_distinct(flatten(list(paths)))) AS fields FROM s WHERE rn <= 20 GROUP BY type, check_at),
h AS (SELECT *, substr(sha256('[' || array_to_string(fields, ', ') || ']'), 1, 16) AS schema_hash FROM c),
l AS (SELECT *, lag(schema_hash) OVER (PARTITION BY type ORDER BY check_at) AS prev_hash,
             lag(fields) OVER (PARTITION BY type ORDER BY check_at) AS prev_fields FROM h)
"""


@query("schema_drift", DRIFT_SQL + """
SELECT type, strftime(check_at, '%Y-%m-%d %H:%M:%S') AS check_at, sample_count, schema_hash,
  CASE WHEN prev_hash IS NULL THEN 'FIRST' WHEN prev_hash = schema_hash THEN 'SAME' ELSE 'DRIFT' END AS outcome,
  CASE WHEN prev_hash <> schema_hash THEN array_to_string(list_sort(list_filter(fields, lambda x: NOT list_contains(prev_fields, x))), ',') END AS added,
  CASE WHEN prev_hash <> schema_hash THEN array_to_string(list_sort(list_filter(prev_fields, lambda x: NOT list_contains(fields, x))), ',') END AS removed
FROM l""")
def schema_drift(spark, sf):
    checks = D.schema_checks(D.check_samples(shaped_events(spark, sf), check="1 day"))
    return checks.select("type", fmt("check_at").alias("check_at"), "sample_count", "schema_hash", "outcome",
                         F.array_join("added", ",").alias("added"), F.array_join("removed", ",").alias("removed"))


@query("drift_alerts", DRIFT_SQL + """
SELECT type AS event_type, strftime(check_at, '%Y-%m-%d %H:%M:%S') AS check_at,
  'Schema change detected for ' || type AS title,
  trim(CASE WHEN len(list_filter(fields, lambda x: NOT list_contains(prev_fields, x))) > 0 THEN 'New fields: [' ||
    array_to_string(list_sort(list_filter(fields, lambda x: NOT list_contains(prev_fields, x))), ', ') || ']. ' ELSE '' END ||
  CASE WHEN len(list_filter(prev_fields, lambda x: NOT list_contains(fields, x))) > 0 THEN 'Missing fields: [' ||
    array_to_string(list_sort(list_filter(prev_fields, lambda x: NOT list_contains(fields, x))), ', ') || ']. ' ELSE '' END) AS description
FROM l WHERE prev_hash <> schema_hash""")
def drift_alerts(spark, sf):
    a = D.drift_alerts(D.schema_checks(D.check_samples(shaped_events(spark, sf), check="1 day")))
    return a.select("event_type", fmt("check_at").alias("check_at"), "title", "description")


@query("schema_snapshots", DRIFT_SQL + """
SELECT type AS event_type, schema_hash, count(*) AS checks,
  strftime(min(check_at), '%Y-%m-%d %H:%M:%S') AS first_seen_at, strftime(max(check_at), '%Y-%m-%d %H:%M:%S') AS last_seen_at
FROM l GROUP BY type, schema_hash""")
def schema_snapshots(spark, sf):
    checks = D.schema_checks(D.check_samples(shaped_events(spark, sf), check="1 day"))
    snap = D.snapshots(checks)
    n = checks.groupBy(F.col("type").alias("event_type"), "schema_hash").agg(F.count(F.lit(1)).alias("checks"))
    return snap.join(n, ["event_type", "schema_hash"]).select(
        "event_type", "schema_hash", "checks", fmt("first_seen_at").alias("first_seen_at"),
        fmt("last_seen_at").alias("last_seen_at"))


DRIFT_ALL_SQL = DRIFT_SQL.replace(" WHERE rn <= 20", "")


@query("schema_drift_all", DRIFT_ALL_SQL + """
SELECT type, strftime(check_at, '%Y-%m-%d %H:%M:%S') AS check_at, sample_count, array_to_string(fields, ',') AS fields,
  CASE WHEN prev_hash IS NULL THEN 'FIRST' WHEN prev_hash = schema_hash THEN 'SAME' ELSE 'DRIFT' END AS outcome FROM l""")
def schema_drift_all(spark, sf):
    """DRIFT-1 over all payloads of each (type, day)."""
    checks = D.schema_checks(D.check_samples(shaped_events(spark, sf), check="1 day", n=None))
    return checks.select("type", fmt("check_at").alias("check_at"), "sample_count",
                         F.array_join("field_names", ",").alias("fields"), "outcome")


@query("schema_snapshots_all", DRIFT_ALL_SQL + """
SELECT type AS event_type, schema_hash, array_to_string(arg_min(fields, check_at), ',') AS fields,
  CAST(coalesce(arg_max(sample_count, check_at) FILTER (WHERE prev_hash = schema_hash), arg_min(sample_count, check_at)) AS INTEGER) AS sample_count,
  strftime(min(check_at), '%Y-%m-%d %H:%M:%S') AS first_seen_at, strftime(max(check_at), '%Y-%m-%d %H:%M:%S') AS last_seen_at
FROM l GROUP BY type, schema_hash""")
def schema_snapshots_all(spark, sf):
    """SNK-6..8 image over all payloads, with the fields of a schema's first check and the sample count of the last that touched it."""
    snap = D.snapshots(D.schema_checks(D.check_samples(shaped_events(spark, sf), check="1 day", n=None)))
    return snap.select("event_type", "schema_hash", F.array_join("field_names", ",").alias("fields"), "sample_count",
                       fmt("first_seen_at").alias("first_seen_at"), fmt("last_seen_at").alias("last_seen_at"))


# --------------------------------------------------------------------------
# Volume
# --------------------------------------------------------------------------
def _se_window(seconds: int, offset: int = 0) -> str:
    return f"""
WITH c AS (SELECT event_type, 'src-' || CAST(user_id % 5 AS VARCHAR) AS event_source,
             to_timestamp(floor((epoch(ts) - {offset}) / {seconds}) * {seconds} + {offset}) AS window_start,
             count(*) AS event_count
           FROM events GROUP BY 1, 2, 3),
b AS (SELECT *, avg(event_count) OVER w AS a, stddev_samp(event_count) OVER w AS s FROM c
      WINDOW w AS (PARTITION BY event_type, event_source ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT event_type, event_source, window_start, event_count,
             CASE WHEN a IS NOT NULL AND s IS NOT NULL THEN a END AS avg_count,
             CASE WHEN a IS NOT NULL AND s IS NOT NULL THEN s END AS stddev_count FROM b)
"""


@query("volume_baseline", _se_window(86400) + """
SELECT event_type, event_source, strftime(window_start AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS window_start, event_count,
  round(avg_count, 4) AS avg_count, round(stddev_count, 4) AS stddev_count FROM g""")
def volume_baseline(spark, sf):
    base = ST.baselines(ST.window_counts(stored_events(spark, sf), "1 day"))
    return base.select("event_type", "event_source", fmt("window_start").alias("window_start"), "event_count",
                       F.round("avg_count", 4).alias("avg_count"), F.round("stddev_count", 4).alias("stddev_count"))


@query("volume_spike", _se_window(86400) + """
SELECT event_type, event_source, strftime(window_start AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS window_start, event_count,
  round((event_count - avg_count) / stddev_count, 4) AS score, 'HIGH' AS severity FROM g
WHERE stddev_count IS NOT NULL AND stddev_count <> 0 AND event_count >= 10
  AND (event_count - avg_count) / stddev_count > 3.0""")
def volume_spike(spark, sf):
    _, alerts = ST.detect_volume(stored_events(spark, sf), "1 day")
    sp = alerts.filter(F.col("severity") == "HIGH")
    return sp.select("event_type", "event_source", fmt("window_start").alias("window_start"), "event_count",
                     F.round("score", 4).alias("score"), "severity")


@query("volume_descriptions", _se_window(86400) + """
SELECT event_type, event_source, strftime(window_start AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS window_start,
  CASE WHEN event_count < avg_count THEN 'Volume drop detected' ELSE 'Volume spike detected' END AS title,
  event_type || ' events from ' || event_source || ': ' || event_count || ' events in last 1440 min (avg: ' ||
  CAST(round(avg_count) AS BIGINT) || CASE WHEN event_count < avg_count
    THEN ', drop: ' || CAST(round((1 - event_count / avg_count) * 100) AS BIGINT) || '%)'
    ELSE printf(', z-score: %.1f)', (event_count - avg_count) / stddev_count) END AS description
FROM g WHERE stddev_count IS NOT NULL AND stddev_count <> 0 AND event_count >= 10
  AND ((event_count - avg_count) / stddev_count > 2.0 OR (event_count < avg_count * 0.8 AND avg_count > 10))""")
def volume_descriptions(spark, sf):
    """FN-10: alert titles and texts, at thresholds low enough for many alerts."""
    _, alerts = ST.detect_volume(stored_events(spark, sf), "1 day", spike_z=2.0, drop_ratio=0.8)
    return alerts.select("event_type", "event_source", fmt("window_start").alias("window_start"), "title", "description")


@query("volume_drop", _se_window(604800, 4 * 86400) + """
SELECT event_type, event_source, strftime(window_start AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS window_start, event_count,
  round((1 - event_count / avg_count) * 100, 4) AS score, 'MEDIUM' AS severity FROM g
WHERE stddev_count IS NOT NULL AND stddev_count <> 0 AND event_count >= 10
  AND event_count < avg_count * 0.3 AND avg_count > 10""")
def volume_drop(spark, sf):
    # Monday-aligned weeks: the last (partial) week of the data is the drop
    _, alerts = ST.detect_volume(stored_events(spark, sf), "7 days", start_time="4 days")
    d = alerts.filter(F.col("severity") == "MEDIUM")
    return d.select("event_type", "event_source", fmt("window_start").alias("window_start"), "event_count",
                    F.round("score", 4).alias("score"), "severity")


@query("sliding_counts", """
SELECT strftime(to_timestamp(floor(epoch(ts) / 30) * 30 - k * 30) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS window_start,
  event_type AS type, 'src-' || CAST(user_id % 5 AS VARCHAR) AS source, count(*) AS event_count
FROM events, range(10) t(k) GROUP BY 1, 2, 3""")
def sliding_counts(spark, sf):
    from eventide.streaming.windows import sliding_counts as sc
    out = sc(stored_events(spark, sf))
    return out.select(fmt("window_start").alias("window_start"), "type", "source", "event_count")


# --------------------------------------------------------------------------
# Embeddings
# --------------------------------------------------------------------------
EMB_SQL = """
WITH s AS (SELECT vec_id, label, embedding FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id DESC) AS rn
           FROM embeddings) WHERE rn <= 20),
n AS (SELECT label FROM s GROUP BY label HAVING count(*) >= 3),
x AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS pos
      FROM s WHERE label IN (SELECT label FROM n)),
c AS (SELECT label, pos, avg(v) AS cv FROM x GROUP BY label, pos),
d AS (SELECT x.vec_id, x.label, sum(x.v * c.cv) AS dot, sqrt(sum(x.v * x.v)) AS na, sqrt(sum(c.cv * c.cv)) AS nb
      FROM x JOIN c USING (label, pos) GROUP BY 1, 2),
r AS (SELECT CAST(vec_id AS VARCHAR) AS id, CAST(label AS VARCHAR) AS type,
             1 - CASE WHEN na * nb = 0 THEN 0 ELSE dot / (na * nb) END AS distance FROM d)
"""


@query("centroids", EMB_SQL + "SELECT CAST(label AS VARCHAR) AS type, CAST(pos - 1 AS INTEGER) AS dim, round(cv, 4) AS value FROM c")
def centroids_q(spark, sf):
    from eventide.functions.vectors import centroids
    s = latest_n(event_vectors(spark, sf), ["type"], [F.col("seq").desc()], 20)
    c = centroids(s, "type", "vector").filter("n >= 3")
    return c.select("type", F.posexplode("centroid").alias("dim", "value")).withColumn("value", F.round("value", 4))


@query("cosine_distance", EMB_SQL + "SELECT id, type, round(distance, 4) AS distance FROM r")
def cosine_distance_q(spark, sf):
    d = EMB.distances(event_vectors(spark, sf))
    return d.select("id", "type", F.round("distance", 4).alias("distance"))


@query("embedding_outliers", EMB_SQL + "SELECT id AS event_id, type AS event_type, round(distance, 4) AS distance, "
       "'LOW' AS severity FROM r WHERE distance > 0.85")
def embedding_outliers(spark, sf):
    o = EMB.outliers(event_vectors(spark, sf))
    return o.select("event_id", "event_type", F.round("distance", 4).alias("distance"), "severity")


EMB_ALL_SQL = EMB_SQL.replace(" WHERE rn <= 20", "")


@query("centroids_all", EMB_ALL_SQL + "SELECT CAST(label AS VARCHAR) AS type, CAST(pos - 1 AS INTEGER) AS dim, "
       "round(cv, 4) AS value FROM c")
def centroids_all(spark, sf):
    """AGG-12 over all vectors of a type."""
    from eventide.functions.vectors import centroids
    c = centroids(event_vectors(spark, sf), "type", "vector").filter("n >= 3")
    return c.select("type", F.posexplode("centroid").alias("dim", "value")).withColumn("value", F.round("value", 4))


@query("cosine_distance_all", EMB_ALL_SQL + "SELECT id, type, round(distance, 4) AS distance FROM r")
def cosine_distance_all(spark, sf):
    """FN-7 of every vector to the centroid of all vectors of its type."""
    d = EMB.distances(event_vectors(spark, sf), sample=None)
    return d.select("id", "type", F.round("distance", 4).alias("distance"))


@query("embedding_outliers_all", EMB_ALL_SQL + "SELECT id AS event_id, type AS event_type, round(distance, 4) AS distance, "
       "'LOW' AS severity FROM r WHERE distance > 0.85")
def embedding_outliers_all(spark, sf):
    """EMB-1 over all vectors."""
    o = EMB.outliers(event_vectors(spark, sf), sample=None)
    return o.select("event_id", "event_type", F.round("distance", 4).alias("distance"), "severity")


# --------------------------------------------------------------------------
# Alerts over the detectors' output
# --------------------------------------------------------------------------
def alert_table(spark, sf):
    _, vol = ST.detect_volume(stored_events(spark, sf), "1 day")
    vol = A.to_alerts(vol.withColumn("details", fmt("window_start")),
                      ["event_type", "event_source", "window_start"])
    dr = D.drift_alerts(D.schema_checks(D.check_samples(shaped_events(spark, sf), check="1 day")))
    dr = A.to_alerts(dr.withColumn("details", fmt("check_at")), ["event_type", "check_at"])
    em = A.to_alerts(EMB.outliers(event_vectors(spark, sf)), ["event_type", "event_id"])
    return vol.unionByName(dr).unionByName(em)


VOL_ALERTS = ("stddev_count IS NOT NULL AND stddev_count <> 0 AND event_count >= 10 AND "
              "((event_count - avg_count) / stddev_count > 3.0 OR (event_count < avg_count * 0.3 AND avg_count > 10))")


@query("alert_stats", f"""
SELECT v.n + d.n + e.n AS total, v.n + d.n + e.n - e0.n AS open, e0.n AS resolved FROM
  ({_se_window(86400)} SELECT count(*) AS n FROM g WHERE {VOL_ALERTS}) v,
  ({DRIFT_SQL} SELECT count(*) AS n FROM l WHERE prev_hash <> schema_hash) d,
  ({EMB_SQL} SELECT count(*) AS n FROM r WHERE distance > 0.85) e,
  ({EMB_SQL} SELECT count(*) AS n FROM r WHERE distance > 0.85 AND type IN ('0', '1')) e0""")
def alert_stats(spark, sf):
    """AGG-9 after SNK-9/10: the detectors' alerts are stored once, then resolved and counted."""
    path = f"{checkpoint_dir(spark)}/alerts-{uuid.uuid4().hex}"
    alert_table(spark, sf).write.parquet(path)
    alerts = spark.read.parquet(path)
    res = alerts.filter((F.col("detector_type") == "EMBEDDING") & F.col("event_type").isin("0", "1")).select("id")
    resolved, _ = A.resolve(alerts, res)
    return A.alert_stats(resolved)


ALERTS_SQL = f"""(SELECT 'STATISTICAL' AS d, event_type AS t, FALSE AS r
    FROM ({_se_window(86400)} SELECT event_type FROM g WHERE {VOL_ALERTS})
  UNION ALL SELECT 'SCHEMA_DRIFT', type, FALSE FROM ({DRIFT_SQL} SELECT type FROM l WHERE prev_hash <> schema_hash)
  UNION ALL SELECT 'EMBEDDING', type, type IN ('0', '1') FROM ({EMB_SQL} SELECT type FROM r WHERE distance > 0.85))"""


@query("alerts_by_filter", " UNION ALL ".join(
    f"SELECT '{name}' AS filter, d AS detector_type, count(*) AS alerts FROM {ALERTS_SQL} WHERE {cond} GROUP BY d"
    for name, cond in (("detector", "d = 'STATISTICAL'"), ("type", "t = 'purchase'"), ("open", "NOT r"),
                       ("resolved", "r"), ("all", "TRUE"))))
def alerts_by_filter(spark, sf):
    """FLT-8: each branch that can decide, over alerts stored once and resolved."""
    path = f"{checkpoint_dir(spark)}/alerts-{uuid.uuid4().hex}"
    alert_table(spark, sf).write.parquet(path)
    alerts = spark.read.parquet(path)
    res = alerts.filter((F.col("detector_type") == "EMBEDDING") & F.col("event_type").isin("0", "1")).select("id")
    alerts, _ = A.resolve(alerts, res)
    branches = {"detector": {"detector_type": "STATISTICAL", "event_type": "purchase", "resolved": True},
                "type": {"event_type": "purchase", "resolved": True},
                "open": {"resolved": False}, "resolved": {"resolved": True}, "all": {}}
    parts = [A.filter_alerts(alerts, **given).groupBy("detector_type").agg(F.count(F.lit(1)).alias("alerts"))
             .select(F.lit(name).alias("filter"), "detector_type", "alerts") for name, given in branches.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("alerts_filtered", f"""
SELECT 'STATISTICAL' AS detector_type, event_type, event_source, 'Volume drop detected' AS title
FROM ({_se_window(86400)} SELECT * FROM g WHERE stddev_count IS NOT NULL AND stddev_count <> 0 AND event_count >= 10
      AND event_count < avg_count * 0.3 AND avg_count > 10)
UNION ALL SELECT 'SCHEMA_DRIFT', type, NULL, 'Schema change detected for ' || type
FROM ({DRIFT_SQL} SELECT * FROM l WHERE prev_hash <> schema_hash)""")
def alerts_filtered(spark, sf):
    """FLT-8: severity outranks event type (ignored) -> every MEDIUM alert."""
    a = A.filter_alerts(alert_table(spark, sf), severity="MEDIUM", event_type="purchase")
    return a.select("detector_type", "event_type", "event_source", "title")


@query("alerts_by_detector", f"""
SELECT 'EMBEDDING' AS detector_type, type AS event_type, id AS event_id, type IN ('0', '1') AS resolved
FROM ({EMB_SQL} SELECT * FROM r WHERE distance > 0.85)""")
def alerts_by_detector(spark, sf):
    """FLT-8 by detector + SNK-10 resolutions applied in one pass."""
    alerts = alert_table(spark, sf)
    res = alerts.filter((F.col("detector_type") == "EMBEDDING") & F.col("event_type").isin("0", "1")).select("id")
    resolved, unknown = A.resolve(alerts, res)
    return A.filter_alerts(resolved, detector_type="EMBEDDING").select(
        "detector_type", "event_type", "event_id", "resolved")


@query("resolve_unknown", f"""
SELECT 'no-alert-' || CAST(label AS VARCHAR) AS id FROM (SELECT DISTINCT label FROM embeddings)""")
def resolve_unknown(spark, sf):
    """SNK-10: ids to resolve that no alert carries are reported, the others are not."""
    em = A.to_alerts(EMB.outliers(event_vectors(spark, sf), sample=None), ["event_type", "event_id"])
    asked = event_vectors(spark, sf).select(F.concat(F.lit("no-alert-"), "type").alias("id")).unionByName(em.select("id"))
    return A.resolve(em, asked)[1]


LIVE_AS_OF = "2024-01-30 12:00:00"
LIVE_START = "2024-01-29 12:00:00"
SRC = "'src-' || CAST(user_id % 5 AS VARCHAR)"


@query("volume_live_check", f"""
WITH h AS (SELECT event_type, {SRC} AS event_source, floor(epoch(ts) / 86400) AS d, count(*) AS c
           FROM events WHERE ts < TIMESTAMP '{LIVE_START}' GROUP BY 1, 2, 3),
hs AS (SELECT event_type, event_source, avg(c) AS a, stddev_samp(c) AS s FROM h GROUP BY 1, 2),
cur AS (SELECT event_type, {SRC} AS event_source, count(*) AS event_count FROM events
        WHERE ts BETWEEN TIMESTAMP '{LIVE_START}' AND TIMESTAMP '{LIVE_AS_OF}' GROUP BY 1, 2)
SELECT cur.event_type, cur.event_source, event_count,
  round(CASE WHEN a IS NOT NULL AND s IS NOT NULL THEN a END, 4) AS avg_count,
  round(CASE WHEN a IS NOT NULL AND s IS NOT NULL THEN s END, 4) AS stddev_count
FROM cur LEFT JOIN hs USING (event_type, event_source)""")
def volume_live_check(spark, sf):
    """STAT-1 live form (FLT-9, JN-2): one check at a fixed clock over the
    trailing day, against the daily baselines saved before that window."""
    ev = stored_events(spark, sf)
    hist = ST.baselines(ST.window_counts(ev.filter(F.col("received_at") < F.lit(LIVE_START).cast("timestamp")),
                                         "1 day"))
    base, _ = ST.live_check(ev, hist, LIVE_AS_OF, window_minutes=1440)
    return base.select("event_type", "event_source", "event_count", F.round("avg_count", 4).alias("avg_count"),
                       F.round("stddev_count", 4).alias("stddev_count"))


@query("baseline_upsert", f"""
WITH old AS (SELECT event_type, {SRC} AS event_source, floor(epoch(ts) / 86400) AS d,
               count(*) FILTER (WHERE value > 100) AS event_count FROM events
             WHERE ts < TIMESTAMP '2024-01-21 00:00:00' GROUP BY 1, 2, 3),
new AS (SELECT event_type, {SRC} AS event_source, floor(epoch(ts) / 86400) AS d, count(*) AS event_count
        FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1, 2, 3)
SELECT event_type, event_source, strftime(to_timestamp(d * 86400) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS window_start,
  event_count FROM new
UNION ALL SELECT event_type, event_source, strftime(to_timestamp(d * 86400) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S'),
  event_count FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.event_type = old.event_type
  AND new.event_source = old.event_source AND new.d = old.d)""")
def baseline_upsert(spark, sf):
    """SNK-5: keyed upsert of baseline rows on (type, source, window_start):
    an older table image (counts of large-value events up to day 20) updated
    by fresh counts from day 15 on; conflicting keys take the new row."""
    from eventide.operators.store import upsert
    from eventide.sources.adapters import table
    e = table(spark, sf, "events").filter(F.col("ts") < F.lit("2024-01-21 00:00:00").cast("timestamp_ntz"))
    w = F.window(F.col("ts").cast("timestamp"), "1 day")
    old = (e.groupBy(F.col("event_type"), F.concat(F.lit("src-"), (F.col("user_id") % 5).cast("string"))
                     .alias("event_source"), w.alias("w"))
           .agg(F.count_if(F.col("value") > 100).alias("event_count"))
           .select("event_type", "event_source", F.col("w.start").alias("window_start"),
                   F.col("w.end").alias("window_end"), "event_count"))
    fresh = stored_events(spark, sf).filter(F.col("received_at") >= F.lit("2024-01-15 00:00:00").cast("timestamp"))
    new = ST.window_counts(fresh, "1 day")
    img = upsert(old, new, ["event_type", "event_source", "window_start"])
    return img.select("event_type", "event_source", fmt("window_start").alias("window_start"), "event_count")
