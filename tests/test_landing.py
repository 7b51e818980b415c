"""Landing by the id index, keyed tables, and live detectors that keep state."""

import datetime as dt
import glob
import json
import os
import random
import tempfile

from pyspark.sql import functions as F

from eventide.operators.detect import drift as D
from eventide.operators.detect import statistical as ST
from eventide.operators.landing import IdIndex, find_event, land_batch
from eventide.operators.store import KeyedTable, dedup_first
from eventide.streaming import state as S
from eventide.streaming.jobs import content_stream, drift_stream, volume_stream

EVENT = "id string, type string, source string, payload string, received_at timestamp, stored_at timestamp, offset long"
T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def events(spark, rows):
    """Rows of (id, seconds after T0, payload, offset)."""
    return spark.createDataFrame([(i, "click", "web", p, T0 + dt.timedelta(seconds=s) if s is not None else None,
                                   T0 + dt.timedelta(seconds=s or 0), o) for i, s, p, o in rows], EVENT)


def plan(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def ids(spark, path):
    return sorted(r[0] for r in spark.read.parquet(path).select("id").collect())


def test_land_batches_replays_and_lookup(spark):
    base = tempfile.mkdtemp(prefix="eventide-land-")
    table = os.path.join(base, "table")
    index = IdIndex.beside(spark, table, buckets=16)
    order = [F.col("offset")]
    land_batch(spark, events(spark, [(f"e{i}", 86400 * (i % 3), "a", i) for i in range(20)] + [("e3", 9, "copy", 99), (None, 1, "x", 5)]),
               table, order, "r1", 0, index)
    assert ids(spark, table) == sorted(f"e{i}" for i in range(20))
    second = events(spark, [("e3", 86400 * 50, "late copy", 1), ("new", None, "n", 2), ("new", 5, "m", 1)])
    for _ in range(2):  # a replay replaces what the batch wrote
        land_batch(spark, second, table, order, "r1", 1, index)
        assert ids(spark, table) == sorted([f"e{i}" for i in range(20)] + ["new"])
    land_batch(spark, second, table, order, "r2", 0, index)
    assert len(ids(spark, table)) == 21
    assert [r["payload"] for r in find_event(spark, table, "e3", index).collect()] == ["a"]
    assert [r["payload"] for r in find_event(spark, table, "new", index).collect()] == ["m"]
    assert find_event(spark, table, "none", index).collect() == []
    land_batch(spark, events(spark, [("undated", None, "u", 0)]), table, order, "r2", 1, index)
    assert [r["payload"] for r in find_event(spark, table, "undated", index).collect()] == ["u"]
    land_batch(spark, events(spark, []), table, order, "r2", 2, index)
    assert len(ids(spark, table)) == 22


def test_landing_plan_is_pruned_and_single_pass(spark):
    base = tempfile.mkdtemp(prefix="eventide-land-")
    table = os.path.join(base, "table")
    index = IdIndex.beside(spark, table, buckets=64)
    land_batch(spark, events(spark, [(f"e{i}", i, "a", i) for i in range(200)]), table, [F.col("offset")], "r", 0, index)
    known = index.of(events(spark, [("e1", 1, "a", 1), ("e2", 1, "a", 1)]))
    assert "PartitionFilters: [id_bucket" in plan(known) and known.select("id_bucket").distinct().count() <= 2
    one = plan(index.find("e7"))
    assert "PartitionFilters: [isnotnull(id_bucket" in one and "EqualTo(id,e7)" in one
    rows = spark.read.schema(EVENT).parquet(table)
    first = plan(dedup_first(rows, [F.col("offset")]))
    assert "SortAggregate" not in first and first.count("WindowGroupLimit") >= 2 and first.count("Scan parquet") == 2  # tree and details


def test_index_sync_and_merge(spark):
    base = tempfile.mkdtemp(prefix="eventide-land-")
    table = os.path.join(base, "table")
    old = events(spark, [(f"o{i}", i, "a", i) for i in range(10)]).withColumn("received_date", F.to_date("received_at"))
    old.write.partitionBy("received_date").parquet(f"{table}/run=before/batch=0")  # a table without an index
    index = IdIndex.beside(spark, table, buckets=8)
    index.sync(table)
    order = [F.col("offset")]
    for b in range(4):
        land_batch(spark, events(spark, [(f"e{b}", b, "a", b), ("o1", 3, "again", 0)]), table, order, "r", b, index)
    want = ids(spark, table)
    assert want == sorted([f"o{i}" for i in range(10)] + [f"e{b}" for b in range(4)])
    for _ in range(2):
        index.merge()
        assert sorted(r[0] for r in index.read().select("id").distinct().collect()) == want
        assert len(os.listdir(f"{index.path}/run=r")) == 1  # the batch that may be replayed
    index.sync(table)
    assert index.read().count() == len(want)
    land_batch(spark, events(spark, [("e0", 1, "x", 1), ("e3", 1, "x", 1)]), table, order, "r", 4, index)
    assert ids(spark, table) == want


def test_keyed_table_rewrites_touched_buckets(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="eventide-keyed-"), "t")
    t = KeyedTable(spark, path, ["k", "s"], buckets=8)
    schema = "k long, s string, v long, first long"
    assert t.read() is None
    t.upsert(spark.createDataFrame([(i, None if i % 2 else "s", i, i) for i in range(40)], schema))
    before = t.folders()
    update = spark.createDataFrame([(1, None, 100, 100), (99, "s", 5, 5)], schema)
    for _ in range(2):  # replayed: the same
        t.upsert(update, keep_on_conflict=["first"], version=1)
        rows = {(r["k"], r["s"]): (r["v"], r["first"]) for r in t.read().collect()}
        assert rows[1, None] == (100, 1) and rows[99, "s"] == (5, 5) and len(rows) == 41 and t.read().count() == 41
    after = t.folders()
    same = [b for b in before if after[b] == before[b]]
    assert len(same) >= len(before) - 2 and set(after) >= set(before)
    os.remove(f"{path}/version=1/_SUCCESS")  # an update that did not finish does not count
    assert t.read().count() == 40 and t.folders() == before
    t.upsert(update, keep_on_conflict=["first"], version=1)
    t.upsert(spark.createDataFrame([(i, None if i % 2 else "s", 7, 7) for i in range(40)], schema))
    t.vacuum()
    assert t.read().count() == 41 and {r["v"] for r in t.read().collect()} == {7, 5}


def batches(spark, base, parts):
    for n, rows in enumerate(parts):
        events(spark, rows).coalesce(1).write.parquet(os.path.join(base, "ev", f"{n:03d}"))


def stream(spark, base, lo, hi):
    """A stream over the batches lo to hi, one file a micro-batch."""
    part = os.path.join(base, f"in-{lo}-{hi}")
    for n in range(lo, hi):
        spark.read.schema(EVENT).parquet(os.path.join(base, "ev", f"{n:03d}")).coalesce(1).write.mode("append").parquet(part)
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(part)


def test_second_counts_keep_both_ends(spark):
    base = tempfile.mkdtemp(prefix="eventide-cnt-")
    r = random.Random(2)
    times = [r.choice([0, 1, 299, 300, 301, 3599, 3600, 3601, 3900]) + r.choice([0, 0, 0.000001, 0.5, 0.999999]) for _ in range(300)]
    ev = events(spark, [(f"e{i}", t, "{}", i) for i, t in enumerate(times)] + [("none", None, "{}", 1)])
    counts = S.TrailingCounts(spark, os.path.join(base, "c"))
    for k in range(3):
        counts.add(ev.filter(F.col("offset") % 3 == k), "r", k)
    counts.add(ev.filter(F.col("offset") % 3 == 1), "r", 1)  # replayed
    zero = int((T0 - dt.datetime(1970, 1, 1)).total_seconds())
    for end in (300, 301, 3600, 3601, 3900, 4000):
        want = sum(end - 300 <= t <= end for t in times)
        got = counts.window(zero + end, 300).collect()
        assert [x["event_count"] for x in got] == ([want] if want else [])


def test_volume_stream_equals_batch_over_many_batches_with_late_rows_and_a_restart(spark):
    base = tempfile.mkdtemp(prefix="eventide-vol-")
    r = random.Random(5)
    parts, k = [], 0
    for b in range(8):
        n = 60 if b == 6 else r.randint(10, 14)
        late = [(f"late{b}-{i}", 40 * b - r.randint(0, 200) + 400, "{}", 0) for i in range(3)] if b else []
        rows = [(f"e{k + i}", 400 + 40 * b + r.random() * 39, "{}", 0) for i in range(n)]
        k += n
        parts.append(rows + late)
    batches(spark, base, parts)
    where = [os.path.join(base, x) for x in ("bl", "al")]
    for lo, hi, ck in ((0, 3, "a"), (3, 6, "b"), (6, 8, "b2")):
        volume_stream(spark, stream(spark, base, lo, hi), *where, os.path.join(base, ck), window_minutes=1, spike_z=1.5,
                      alert_table=os.path.join(base, "alerts")).awaitTermination(600)
    got = [tuple(x) for x in spark.read.parquet(where[0]).orderBy("window_end").select(
        "window_end", "event_count", "avg_count", "stddev_count").collect()]
    # the same checks in batch, each over all rows read so far
    want, hist, seen = [], None, []
    alerts = []
    for rows in parts:
        seen += rows
        ev = events(spark, seen)
        end = T0 + dt.timedelta(seconds=-(-max(s for _, s, _, _ in rows) // 1))
        b, a = ST.live_check(ev, hist, end, 1, spike_z=1.5)
        b = spark.createDataFrame(b.collect(), b.schema)
        want += [tuple(x) for x in b.select("window_end", "event_count", "avg_count", "stddev_count").collect()]
        alerts += [(x["title"], x["description"]) for x in a.collect()]
        hist = b if hist is None else hist.unionByName(b)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):
        assert all((x is None and y is None) or abs(x - y) < 1e-9 for x, y in zip(g[2:], w[2:]))
    table = spark.read.parquet(os.path.join(base, "alerts"))
    assert alerts and sorted((x["title"], x["description"]) for x in table.collect()) == sorted(alerts)
    assert set(table.columns) >= {"id", "detector_type", "severity", "event_type", "event_source", "event_id", "details", "resolved",
                                  "created_at"}


def test_drift_stream_equals_replay_and_keeps_state_only(spark):
    base = tempfile.mkdtemp(prefix="eventide-drift-")
    shapes = [("a",), ("a",), ("a", "b"), ("a",), ("a",), ("c",), ("c",), ("a",)]
    parts = [[(f"e{b}-{i}", 100 * b + i, json.dumps({k: 1 for k in shape}), 0) for i in range(4)] for b, shape in enumerate(shapes)]
    batches(spark, base, parts)
    checks, alerts = os.path.join(base, "checks"), os.path.join(base, "alerts")
    for lo, hi, ck in ((0, 4, "a"), (4, 8, "b")):
        drift_stream(spark, stream(spark, base, lo, hi), checks, os.path.join(base, ck), sample=3, alert_table=alerts).awaitTermination(600)
    samples = events(spark, [x for p in parts for x in p]).withColumn("check_at", F.timestamp_seconds(
        F.floor(F.unix_seconds("stored_at") / 100) * 100 + 3 + F.lit(0)))
    ends = {b: T0 + dt.timedelta(seconds=100 * b + 3) for b in range(8)}
    replay = D.schema_checks(D.latest_n(samples.withColumn("check_at", F.max("stored_at").over(
        D.Window.partitionBy((F.floor((F.unix_seconds("stored_at") - F.unix_seconds(F.lit(T0))) / 100))))),
        ["type", "check_at"], [F.col("stored_at").desc(), F.col("id").desc()], 3))
    cols = ["check_at", "sample_count", "schema_hash", "outcome", "added", "removed"]
    got = sorted(map(tuple, spark.read.parquet(checks).select(*cols).collect()), key=repr)
    assert got == sorted(map(tuple, replay.select(*cols).collect()), key=repr) and len(got) == len(ends)
    image = S._union([spark.read.parquet(f) for f in list(S.last_folders(spark, f"{checks}_snapshots", "", 0).values())])
    cols = ["event_type", "schema_hash", "field_names", "sample_count", "first_seen_at", "last_seen_at"]
    assert sorted(map(tuple, D.one_image(image).select(*cols).collect()), key=repr) == sorted(
        map(tuple, D.snapshots(replay).select(*cols).collect()), key=repr)
    for folder in S.last_folders(spark, f"{checks}_latest", "", 0).values():
        assert spark.read.parquet(folder).count() == 3  # the sample, not what was read
    rows = spark.read.parquet(alerts).collect()
    assert len(rows) == 4 and {x["title"] for x in rows} == {"Schema change detected for click"}


def test_snapshot_counts_of_touches_and_conflicts(spark):
    def image(*checks):
        rows = [("t", f"2024-01-0{n + 1} 00:00:00", [h], h, c) for n, (h, c) in enumerate(checks)]
        df = spark.createDataFrame(rows, "type string, at string, field_names array<string>, schema_hash string, sample_count long")
        done = D.compare_checks(df.select("type", F.to_timestamp("at").alias("check_at"), "field_names", "schema_hash", "sample_count"))
        whole = {r["schema_hash"]: r["sample_count"] for r in D.snapshots(done).collect()}
        merged = spark.createDataFrame([], D.SCHEMA_SNAPSHOTS)
        for r in sorted(done.collect(), key=lambda r: r["check_at"]):
            step = D.merge_snapshots(merged, spark.createDataFrame([r], done.schema))
            merged = spark.createDataFrame(step.collect(), D.SCHEMA_SNAPSHOTS)
        assert {r["schema_hash"]: r["sample_count"] for r in merged.collect()} == whole
        return whole
    assert image(("A", 20), ("A", 5)) == {"A": 5}
    assert image(("A", 20), ("B", 7), ("A", 5)) == {"A": 20, "B": 7}
    assert image(("A", 20), ("A", 6), ("B", 7), ("A", 5), ("A", 4)) == {"A": 4, "B": 7}


def test_content_stream_alerts_once(spark):
    base = tempfile.mkdtemp(prefix="eventide-emb-")
    schema = "id string, type string, seq long, vector array<double>"
    rows = [(f"v{i}", "t", i, [1.0, 0.01 * i]) for i in range(10)] + [("odd", "t", 10, [-1.0, 0.0])] + \
        [(f"w{i}", "t", 11 + i, [1.0, 0.01 * i]) for i in range(5)]
    for n, part in enumerate((rows[:5], rows[5:11], rows[11:])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(os.path.join(base, "ev"))
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(base, "ev"))
    content_stream(spark, s, os.path.join(base, "al"), os.path.join(base, "ck"), alert_table=os.path.join(base, "table")).awaitTermination(600)
    assert [r["event_id"] for r in spark.read.parquet(os.path.join(base, "al")).collect()] == ["odd"]
    assert [(r["detector_type"], r["event_id"], r["resolved"]) for r in spark.read.parquet(os.path.join(base, "table")).collect()] == [
        ("EMBEDDING", "odd", False)]


def test_files_of_a_batch_are_few_and_small(spark, tmp_path):
    """A file a date whatever the tasks, each with a Bloom filter of the size that its ids need (r03 F1, F2)."""
    rows = spark.range(0, 200, 1, 4).select(
        F.format_string("e%d", "id").alias("id"), F.col("id").alias("seq"),
        F.timestamp_seconds(F.col("id") % 5 * 86400).alias("received_at"))
    path = str(tmp_path / "t")
    index = IdIndex.beside(spark, path, 4)
    land_batch(spark, rows, path, [F.col("seq")], "r", 0, index)
    for root, n in ((path, 5), (index.path, 4)):
        files = glob.glob(f"{root}/**/*.parquet", recursive=True)
        assert len(files) == n
        assert all(os.path.getsize(f) < 50_000 for f in files)
    assert find_event(spark, path, "e7", index).count() == 1


def test_an_hour_of_counts_is_one_file(spark, tmp_path):
    """Whatever the tasks that counted its seconds (r03 F6)."""
    ev = spark.range(0, 400, 1, 4).select(
        F.format_string("t%d", F.col("id") % 7).alias("type"), F.lit("web").alias("source"),
        F.timestamp_seconds(F.col("id") % 4 * 3600 + F.col("id")).alias("received_at"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        counts = S.TrailingCounts(spark, str(tmp_path / "c"))
        counts.add(ev, "r", 0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    hours = glob.glob(f"{tmp_path}/c/hour=*")
    files = glob.glob(f"{tmp_path}/c/**/*.parquet", recursive=True)
    assert len(hours) >= 4 and len(files) == len(hours)
    assert counts.window(8 * 3600, 8 * 3600).agg(F.sum("event_count")).first()[0] == 400
