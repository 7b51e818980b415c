"""File sinks/sources and the live detectors under Structured Streaming."""

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from eventide.model import Flow, m
from eventide.operators.envelope import parse_requests
from eventide.operators.routing import route, transform
from eventide.sources.topics import read_request_file, write_outbox
from eventide.streaming.jobs import drift_stream, volume_stream


def test_request_file_and_outbox(spark):
    base = tempfile.mkdtemp(prefix="eventide-io-")
    path = os.path.join(base, "requests.jsonl")
    with open(path, "w") as f:
        f.write(json.dumps({"type": "order.created", "source": "cli", "payload": {"orderId": 1}}) + "\n")
        f.write("{broken\n")
    r = parse_requests(read_request_file(spark, path)).collect()
    assert [x["valid"] for x in r] == [True, False] and r[1]["malformed"]
    fl = Flow("f", "in", "out", (m("orderId", "id"),))
    rec = spark.createDataFrame([("k", json.dumps({"id": "evt_1", "type": "t", "source": "s",
                                                   "payload": {"orderId": 1}}))], "key string, value string")
    write_outbox(route(transform(rec, fl), fl), path=os.path.join(base, "outbox"))
    back = spark.read.parquet(os.path.join(base, "outbox"))
    assert [r["topic"] for r in back.collect()] == ["out"]


def _events(spark, base, days):
    rows, k = [], 0
    for day, n in enumerate(days):
        for i in range(n):
            rows.append((f"e{k}", "click", "web", dt.datetime(2024, 1, 1 + day, 0, 0, 0) + dt.timedelta(seconds=i),
                         json.dumps({"a": 1, **({"b": 2} if day == 2 else {})})))
            k += 1
    df = spark.createDataFrame(rows, "id string, type string, source string, received_at timestamp, payload string")
    df = df.withColumn("stored_at", F.col("received_at"))
    for day in range(len(days)):
        df.filter(F.dayofmonth("received_at") == day + 1).coalesce(1).write.parquet(os.path.join(base, "ev", f"d{day}"))
    return df.schema


def test_volume_stream(spark):
    base = tempfile.mkdtemp(prefix="eventide-vol-")
    schema = _events(spark, base, [50, 50, 51, 49, 200])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(base, "ev", "*"))
    q = volume_stream(spark, stream, os.path.join(base, "baselines"), os.path.join(base, "alerts"),
                      os.path.join(base, "ckpt"), window_minutes=1440)
    q.awaitTermination(600)
    base_rows = spark.read.parquet(os.path.join(base, "baselines"))
    assert base_rows.count() == 5
    alerts = spark.read.parquet(os.path.join(base, "alerts")).collect()
    assert [(a["severity"], a["event_count"]) for a in alerts] == [("HIGH", 200)]


def test_volume_stream_counts_the_window_not_the_batch(spark):
    base = tempfile.mkdtemp(prefix="eventide-vol-")
    schema = "id string, type string, source string, payload string, received_at timestamp, stored_at timestamp"
    for k in range(2):
        rows = [(f"{k}-{i}", "t", "s", "{}", f"2024-01-01 00:0{k}:{i:02d}") for i in range(20)]
        spark.createDataFrame(rows, "id string, type string, source string, payload string, ts string").selectExpr(
            "id", "type", "source", "payload", "cast(ts as timestamp) received_at", "cast(ts as timestamp) stored_at") \
            .coalesce(1).write.parquet(os.path.join(base, "ev", str(k)))
    for k in range(2):
        stream = spark.readStream.schema(schema).parquet(os.path.join(base, "ev", str(k)))
        volume_stream(spark, stream, os.path.join(base, "bl"), os.path.join(base, "al"),
                      os.path.join(base, f"ck{k}")).awaitTermination(600)
    got = spark.read.parquet(os.path.join(base, "bl")).orderBy("window_end").collect()
    assert [r["event_count"] for r in got] == [20, 40]


def test_drift_stream(spark):
    base = tempfile.mkdtemp(prefix="eventide-drift-")
    schema = _events(spark, base, [5, 5, 5, 5])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(base, "ev", "*"))
    q = drift_stream(spark, stream, os.path.join(base, "checks"), os.path.join(base, "ckpt"), sample=5)
    q.awaitTermination(600)
    checks = spark.read.parquet(os.path.join(base, "checks")).orderBy("check_at").collect()
    assert [c["outcome"] for c in checks] == ["FIRST", "SAME", "DRIFT", "DRIFT"]
    assert checks[2]["added"] == ["b"] and checks[3]["removed"] == ["b"]


def test_publish_and_pattern_read(spark):
    from eventide.operators.envelope import build_envelopes
    from eventide.operators.routing import publish
    from eventide.sources.topics import TOPIC_SCHEMA, list_topics, read_topic
    base = tempfile.mkdtemp(prefix="eventide-pub-")
    reqs = parse_requests(spark.createDataFrame(
        [(json.dumps({"type": "t", "source": "s", "payload": {"x": i}}),) for i in range(3)], "value string"))
    out = publish(build_envelopes(reqs.filter("valid"))).persist()
    rows = out.collect()
    assert {r["topic"] for r in rows} == {"events.raw"}
    assert all(json.loads(r["value"])["id"] == r["key"] and json.loads(r["value"])["status"] == "RECEIVED"
               for r in rows)
    recs = spark.createDataFrame([("k1", "{}", "events.raw", 0, 1), ("k2", "{}", "orders.raw", 0, 1),
                                  ("k3", "{}", "__consumer_offsets", 0, 1)], TOPIC_SCHEMA)
    recs.write.parquet(os.path.join(base, "topics"))
    assert read_topic(spark, pattern=r"^[a-z]+\.raw$", path=os.path.join(base, "topics")).count() == 2
    assert [r[0] for r in list_topics(recs).collect()] == ["events.raw", "orders.raw"]


def test_kafka_options_and_tail_offsets(spark):
    import pytest

    from eventide.sources.topics import kafka_options, read_topic_tail, tail_offsets
    assert kafka_options("b:1", "t") == {"kafka.bootstrap.servers": "b:1", "startingOffsets": "earliest", "subscribe": "t"}
    assert kafka_options("b:1", pattern=".*", max_per_trigger=100) == {
        "kafka.bootstrap.servers": "b:1", "startingOffsets": "earliest", "subscribePattern": ".*", "maxOffsetsPerTrigger": "100"}
    with pytest.raises(ValueError):
        kafka_options("b:1")
    start, end = tail_offsets({"t": {0: 5, 1: 0}}, {"t": {0: 8, 1: 100, 2: 0}}, 10)
    assert json.loads(start) == {"t": {"0": 5, "1": 90, "2": 0}} and json.loads(end) == {"t": {"0": 8, "1": 100, "2": 0}}
    base = tempfile.mkdtemp(prefix="eventide-tail-")
    recs = [(f"k{i}", json.dumps({"i": i}) if i % 5 else "x", "t", i % 2, i) for i in range(40)]
    spark.createDataFrame(recs, "key string, value string, topic string, partition int, offset bigint").write.parquet(f"{base}/t")
    assert sorted(r["offset"] for r in read_topic_tail(spark, "t", 3, path=f"{base}/t").collect()) == [34, 36, 38]


def test_transform_stream_writes_topic_folders(spark):
    from eventide.sources.topics import TOPIC_SCHEMA, read_topic
    from eventide.streaming.jobs import transform_stream
    base = tempfile.mkdtemp(prefix="eventide-out-")
    recs = [(f"e{i}", json.dumps({"id": f"e{i}", "type": "t", "source": "s", "payload": {"x": i}}) if i % 2 else "junk", "in", 0, i)
            for i in range(6)]
    spark.createDataFrame(recs, TOPIC_SCHEMA).write.parquet(f"{base}/in")
    fl = Flow("f", "in", "out", (m("x", "x"),), state="ACTIVE")
    transform_stream(spark, read_topic(spark, "in", path=f"{base}/in", stream=True), [fl], f"{base}/box", f"{base}/table",
                     f"{base}/ck", buckets=4).awaitTermination(300)
    run = [n for n in os.listdir(f"{base}/box") if n.startswith("run=")][0]
    assert sorted(n for n in os.listdir(f"{base}/box/{run}/batch=0") if "=" in n) == ["topic=events.failed", "topic=out"]
