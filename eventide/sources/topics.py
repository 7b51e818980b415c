"""SRC-1..6: topic and table reads, batch or streaming, plus sinks SNK-1..3/9.

Topics are Kafka on a cluster (``--packages`` supplies the connector) and
JSON-lines/Parquet folders in tests; both yield ``key, value, topic,
partition, offset`` so every operator is source-agnostic.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.model import DISCOVERY_SAMPLE, SAMPLE_CAP

TOPIC_SCHEMA = "key string, value string, topic string, partition int, offset bigint"


def kafka_options(servers: str, topic: str | None = None, pattern: str | None = None,
                  max_per_trigger: int | None = None, start: str = "earliest", end: str | None = None) -> dict[str, str]:
    """Options of a Kafka read: one topic or all that match ``pattern``."""
    if (topic is None) == (pattern is None):
        raise ValueError("give either a topic or a pattern")
    out = {"kafka.bootstrap.servers": servers, "startingOffsets": start,
           **({"subscribePattern": pattern} if pattern is not None else {"subscribe": topic})}
    if max_per_trigger:
        out["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if end is not None:
        out["endingOffsets"] = end
    return out


def tail_offsets(begin: dict[str, dict[int, int]], end: dict[str, dict[int, int]], n: int) -> tuple[str, str]:
    """(startingOffsets, endingOffsets) of the last ``n`` records of every partition, as Kafka options.

    ``begin`` and ``end`` give the offsets kept by topic and partition; a
    partition with fewer records is read from its first.
    """
    first = {t: {str(p): max(begin.get(t, {}).get(p, 0), e - n) for p, e in ps.items()} for t, ps in end.items()}
    last = {t: {str(p): e for p, e in ps.items()} for t, ps in end.items()}
    return json.dumps(first, sort_keys=True), json.dumps(last, sort_keys=True)


def kafka_offsets(spark: SparkSession, servers: str, topic: str) -> tuple[dict, dict]:
    """First and end offsets of a topic's partitions, from a consumer of the Kafka client that the connector brings."""
    jvm = spark._jvm
    conf = jvm.java.util.Properties()
    conf.put("bootstrap.servers", servers)
    for side in ("key", "value"):
        conf.put(f"{side}.deserializer", "org.apache.kafka.common.serialization.ByteArrayDeserializer")
    consumer = jvm.org.apache.kafka.clients.consumer.KafkaConsumer(conf)
    try:
        parts = jvm.java.util.ArrayList()
        for info in consumer.partitionsFor(topic):
            parts.add(jvm.org.apache.kafka.common.TopicPartition(topic, info.partition()))
        return tuple({topic: {tp.partition(): found[tp] for tp in parts}}
                     for found in (consumer.beginningOffsets(parts), consumer.endOffsets(parts)))
    finally:
        consumer.close()


def read_topic_tail(spark: SparkSession, topic: str, count: int = 5, *, servers: str | None = None,
                    path: str | None = None) -> DataFrame:
    """SRC-3 / TOP-6 from the topic itself: on Kafka only the last records of each partition are read (by offsets)."""
    if servers:
        start, end = tail_offsets(*kafka_offsets(spark, servers, topic), min(count, SAMPLE_CAP))
        options = kafka_options(servers, topic, start=start, end=end)
        records = _records(spark.read.format("kafka").options(**options).load())
    else:
        records = read_topic(spark, topic, path=path)
    return tail_sample(records, count)


def _records(df: DataFrame) -> DataFrame:
    return df.select(F.col("key").cast("string"), F.col("value").cast("string"), "topic", "partition", "offset")


def read_topic(spark: SparkSession, topic: str | None = None, *, pattern: str | None = None,
               servers: str | None = None, path: str | None = None, stream: bool = False,
               max_per_trigger: int | None = None) -> DataFrame:
    """SRC-1 (one topic) / SRC-2 (``pattern``, all topics, from earliest)."""
    if servers:
        r = spark.readStream if stream else spark.read
        options = kafka_options(servers, topic, pattern, max_per_trigger if stream else None)
        return _records(r.format("kafka").options(**options).load())
    if path is None:
        raise ValueError("either servers (Kafka) or path (files) is required")
    r = spark.readStream.schema(TOPIC_SCHEMA) if stream else spark.read.schema(TOPIC_SCHEMA)
    if stream and max_per_trigger:
        r = r.option("maxFilesPerTrigger", max(1, max_per_trigger))
    df = r.parquet(path)
    if topic is not None:
        df = df.filter(F.col("topic") == topic)
    elif pattern is not None:
        df = df.filter(F.col("topic").rlike(pattern))
    return df


def read_request_file(spark: SparkSession, path: str) -> DataFrame:
    """SRC-5: bulk-load event requests, one JSON document per line."""
    return spark.read.text(path)


def list_topics(records: DataFrame) -> DataFrame:
    """SRC-6: non-internal topic names, sorted."""
    return (records.select("topic").filter(~F.col("topic").startswith("__"))
            .distinct().orderBy("topic"))


def tail_sample(records: DataFrame, count: int = 5) -> DataFrame:
    """SRC-3 / TOP-6: the last ``min(count,100)`` records of each partition,
    non-JSON dropped, at most that many in total (first partitions first).

    ``row_number`` per partition is planned with a window-group limit, so each
    task only keeps its top rows per partition before the shuffle.
    """
    n = min(count, SAMPLE_CAP)
    w = Window.partitionBy("topic", "partition").orderBy(F.col("offset").desc())
    tail = records.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n)
    parsed = tail.filter(F.try_parse_json(F.col("value")).isNotNull())
    w2 = Window.partitionBy("topic").orderBy("partition", "offset")
    return (parsed.withColumn("__k", F.row_number().over(w2)).filter(F.col("__k") <= n)
            .drop("__rn", "__k"))


def discovery_sample(records: DataFrame) -> DataFrame:
    """DISC-4 input: 10 tail samples per topic."""
    return tail_sample(records, DISCOVERY_SAMPLE)


def write_outbox(outbox: DataFrame, *, servers: str | None = None, path: str | None = None,
                 mode: str = "append") -> None:
    """SNK-1/2/3: one write; the ``topic`` column chooses destination or dead letter."""
    if servers:
        (outbox.select("topic", "key", "value").write.format("kafka")
         .option("kafka.bootstrap.servers", servers).save())
    else:
        outbox.write.mode(mode).partitionBy("topic").parquet(path)
