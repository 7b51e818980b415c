"""Views over the driver tables in the shapes the operators expect (§7.4).

All adapters are lazy projections/joins over the Parquet scans, so filters
and column pruning still reach the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed adapter constants.
ORDERS_TOPIC = "orders.raw"
ORDER_EVENT_TYPE = "order.created"
ORDER_SOURCE = "orders-db"
ORDER_ID_PREFIX = "evt_ord_"


# Set by a caller whose files have too few splits for its cores (bench); unset, scans keep their splits.
INPUT_PARTITIONS = "spark.eventide.inputPartitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    parts = spark.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(parts)) if parts else df


def stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stored_events`` over the driver ``events`` table."""
    e = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    return e.select(
        F.concat(F.lit("evt_"), F.col("event_id").cast("string")).alias("id"),
        F.col("event_type").alias("type"),
        F.concat(F.lit("src-"), (F.col("user_id") % 5).cast("string")).alias("source"),
        F.col("props").alias("payload"),
        F.lit(None).cast("string").alias("metadata"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("PROCESSED").alias("status"),
        F.lit(None).cast("string").alias("error_message"),
        ts.alias("received_at"), ts.alias("processed_at"), ts.alias("stored_at"),
        F.col("event_id").alias("seq"),
    )


def document_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as a second event source: type = lang, source = source.

    The payload is a JSON object built from the row (text fields included
    whole), so schema discovery and drift see realistic nested payloads.
    """
    d = table(spark, sf_dir, "documents")
    payload = F.to_json(F.struct(
        F.col("doc_id").alias("docId"),
        F.struct(F.col("lang").alias("lang"), F.col("n_chars").alias("chars")).alias("meta"),
        F.col("text").alias("text")))
    return d.select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("id"),
        F.col("lang").alias("type"), F.col("source").alias("source"),
        payload.alias("payload"), F.col("doc_id").alias("seq"))


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw topic of order envelopes (``key``, ``value``, ``topic``, ``offset``).

    Orders still pending carry ``total = "pending"`` (a number-conversion
    failure), and LOW-priority producers add an unknown envelope key
    ``priority`` (an unparseable envelope) -- both derived from the rows.
    """
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    total = F.when(F.col("o_orderstatus") == "P", F.lit("pending").cast("variant")) \
        .otherwise(F.col("o_totalprice").cast("variant"))
    payload = F.struct(
        F.col("o_orderkey").alias("orderId"), total.alias("total"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
        F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                 F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"),
                 F.col("c_nationkey").alias("nation")).alias("customer"),
        F.array(F.struct(F.col("o_orderpriority").alias("label"),
                         F.col("o_orderstatus").alias("code"))).alias("tags"))
    id_ = F.concat(F.lit(ORDER_ID_PREFIX), F.col("o_orderkey").cast("string"))
    base = [id_.alias("id"), F.lit(ORDER_EVENT_TYPE).alias("type"), F.lit(ORDER_SOURCE).alias("source"),
            F.date_format(F.col("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
            payload.alias("payload")]
    envelope = F.when(F.col("o_orderpriority") == "5-LOW",
                      F.to_json(F.struct(*base, F.col("o_orderpriority").alias("priority")))
                      ).otherwise(F.to_json(F.struct(*base)))
    return j.select(id_.alias("key"), envelope.alias("value"), F.lit(ORDERS_TOPIC).alias("topic"),
                    F.col("o_orderkey").alias("offset"),
                    (F.col("o_orderkey") % 4).cast("int").alias("partition"))


def shaped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stored_events`` whose payload shape depends on the row: ``v`` only for
    large values, a nested ``u`` object only for the first users -- the input
    of schema discovery and drift."""
    e = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    payload = F.to_json(F.struct(
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.when(F.col("value") > 100, F.col("value")).alias("v"),
        F.when(F.col("user_id") < 5, F.struct(F.col("user_id").alias("id"))).alias("u")))
    return e.select(
        F.concat(F.lit("evt_"), F.col("event_id").cast("string")).alias("id"),
        F.col("event_type").alias("type"),
        F.concat(F.lit("src-"), (F.col("user_id") % 5).cast("string")).alias("source"),
        payload.alias("payload"), ts.alias("received_at"), ts.alias("stored_at"),
        F.col("event_id").alias("seq"))


def request_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest request bodies from ``conversations``: one request per turn,
    batched per conversation; the source is the first word of the text (blank
    when the text starts otherwise), and system turns arrive as plain text
    (a malformed body)."""
    c = table(spark, sf_dir, "conversations")
    body = F.to_json(F.struct(
        F.col("role").alias("type"), F.regexp_extract("text", r"^(\w+)", 1).alias("source"),
        F.struct(F.col("conv_id").alias("conv"), F.col("turn").alias("turn")).alias("payload")))
    return c.select(F.col("conv_id").alias("batch_id"), "turn",
                    F.when(F.col("role") == "system", F.col("text")).otherwise(body).alias("value"))


def event_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as (id, type, vector, seq); arrival order = vec_id."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").cast("string").alias("id"),
        F.col("label").cast("string").alias("type"),
        F.col("embedding").cast("array<double>").alias("vector"),
        F.col("vec_id").alias("seq"))
