"""STR-2/4/5/6/7: streaming jobs built from the batch operators.

Every job is ``readStream -> DataFrame operators -> writeStream`` with a
checkpoint location; stateful steps that feed themselves (baselines,
snapshots, the landed table) run in ``foreachBatch`` against tables. A batch
writes into a folder keyed by its run (the id in the query's checkpoint) and
batch id with overwrite: replayed after a failure it replaces its own output,
and a query started with a new checkpoint never touches earlier folders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.model import EMBED_BATCH, EMBED_THRESHOLD, SCHEMA_SNAPSHOTS, Flow
from eventide.operators import envelope as ENV
from eventide.operators.alerts import to_alerts
from eventide.operators.detect import drift as D
from eventide.operators.detect import embedding as EMB
from eventide.operators.detect import statistical as ST
from eventide.operators.landing import ID_BUCKETS, IdIndex, land_batch
from eventide.operators.routing import fan_out
from eventide.sources.folders import exists
from eventide.sources.topics import write_outbox
from eventide.streaming.state import (LatestRows, TrailingCounts, add_moments, history, last_folders, moments,
                                      past_moments, write_state)

#: Intervals of the scheduled detectors, as triggers of their streams.
SCHEDULES = {"volume": {"processingTime": "30 seconds"}, "drift": {"processingTime": "60 seconds"},
             "content": {"processingTime": "300 seconds"}}


def _checkpoint(spark: SparkSession, checkpoint: str | None, name: str) -> str:
    """The job's checkpoint: given, else under the shared ``spark.checkpoint.dir``."""
    if checkpoint:
        return checkpoint
    from eventide.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}"


def _read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, None while its folder does not exist; any other failure is raised."""
    if not exists(spark, path):
        return None
    return spark.read.parquet(path)


def _run(batch: DataFrame) -> str:
    """The run a batch belongs to: the id kept in the query's checkpoint."""
    return f"q-{batch.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}"


def _write(df: DataFrame, path: str, run: str, batch_id: int, *partitions: str) -> None:
    df.write.mode("overwrite").partitionBy(*partitions).parquet(f"{path}/run={run}/batch={batch_id}")


def _others(table: DataFrame | None, run: str, batch_id: int) -> DataFrame | None:
    """The table without what this batch may have written before it was replayed."""
    if table is None:
        return None
    return table.filter(~((F.col("run") == run) & (F.col("batch") == batch_id)))


def transform_stream(spark: SparkSession, records: DataFrame, flows: Sequence[Flow], outbox_path: str | None,
                     table_path: str, checkpoint: str | None = None, trigger: dict | None = None,
                     servers: str | None = None, buckets: int = ID_BUCKETS):
    """STR-6 (+ SNK-2/3/4, STR-2): continuous transform and landing.

    Per micro-batch: map every runnable flow (RT-5), write the outbox (to
    Kafka if ``servers`` is given, each row to its topic; to ``outbox_path``,
    partitioned by topic, if that is given) and land each new event id once
    into the ``stored_events`` table (first copy wins, ids already stored are
    found in the index beside it), partitioned by ``date(received_at)``.
    Kafka output is at least once: a replayed batch sends its records again.
    """
    index = IdIndex.beside(spark, table_path, buckets)
    index.sync(table_path)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        run = _run(batch)
        batch = batch.persist()
        out = fan_out(batch, flows).persist() if servers and outbox_path else fan_out(batch, flows)
        try:
            if servers:
                write_outbox(out, servers=servers)
            if outbox_path:
                _write(out, outbox_path, run, batch_id, "topic")
            env = ENV.parse_envelopes(batch).filter("parse_ok")
            arrival = [c for c in ("partition", "offset", "topic") if c in env.columns]  # first copy wins
            rows = ENV.to_table_rows(env, keep=tuple(arrival)).persist()
            order = [F.col(c) for c in arrival] or [F.lit(0)]
            land_batch(spark, rows, table_path, order, run, batch_id, index, drop=arrival)
            rows.unpersist()
        finally:
            out.unpersist()
            batch.unpersist()

    w = records.writeStream.foreachBatch(per_batch).option(
        "checkpointLocation", _checkpoint(spark, checkpoint, "transform"))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def dedup_stream(events: DataFrame, watermark: str = "10 minutes", ts_col: str = "received_at") -> DataFrame:
    """STR-2: once per id within the watermark (older repeats are removed by
    the anti-join in :func:`transform_stream`)."""
    return events.withWatermark(ts_col, watermark).dropDuplicatesWithinWatermark(["id"])


def _alert(rows: DataFrame, keys: list[str], table: str | None, run: str, batch_id: int) -> None:
    """SNK-9: the batch's alerts in the shape of the alert table."""
    if table is not None:
        _write(to_alerts(rows, keys), table, run, batch_id)


def volume_stream(spark: SparkSession, events: DataFrame, baselines_path: str, alerts_path: str,
                  checkpoint: str | None = None, window_minutes: int = 5, trigger: dict | None = None,
                  table_path: str | None = None, alert_table: str | None = None, **thresholds):
    """STR-4/STR-7: the live volume detector, one check per micro-batch.

    The check time is the latest event time of the batch, rounded up to a
    second. The trailing window counts all stored events: from the job's
    per-second counts (hours of the window only), to which each batch adds its
    own, late rows included; with ``table_path`` from that landed table, pruned
    to the dates of the window. History is kept as exact sums per key
    (``<baselines>_moments``), so a check reads neither earlier events nor
    earlier baseline rows. Alerts are written with their figures to
    ``alerts_path`` and as rows of the alert table to ``alert_table``.
    """
    counts = TrailingCounts(spark, f"{baselines_path.rstrip('/')}_counts")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        run = _run(batch)
        end = batch.select(F.max(F.ceil(F.unix_micros("received_at") / F.lit(1000000).cast("decimal(7,0)"))).cast("long")).first()[0]
        if end is None:
            return
        as_of, start = (F.timestamp_seconds(F.lit(n)) for n in (end, end - 60 * window_minutes))
        if table_path is None:
            counts.add(batch, run, batch_id)
            cur = counts.window(end, 60 * window_minutes)
        else:
            seen = spark.read.parquet(table_path).filter(F.col("received_at").between(start, as_of))
            if "received_date" in seen.columns:
                seen = seen.filter(F.col("received_date").between(F.to_date(start), F.to_date(as_of)))
            cur = seen.groupBy(F.col("type").alias("event_type"), F.col("source").alias("event_source")).agg(
                F.count(F.lit(1)).alias("event_count"))
        own, others = past_moments(spark, baselines_path, run, batch_id)
        past = [p for p in (own, others) if p is not None]
        base, _ = ST.check_counts(cur.withColumns({"window_start": start, "window_end": as_of}),
                                  history(add_moments(past)) if past else None, window_minutes, **thresholds)
        _write(base, baselines_path, run, batch_id)
        base = spark.read.schema(base.schema).parquet(f"{baselines_path}/run={run}/batch={batch_id}")
        alerts = ST.volume_alerts(base, window_minutes, **thresholds)
        now = moments(base)
        write_state(add_moments([own, now]) if own is not None else now, f"{baselines_path.rstrip('/')}_moments", run, batch_id)
        _write(alerts, alerts_path, run, batch_id)
        _alert(alerts, ["event_type", "event_source", "window_start"], alert_table, run, batch_id)

    w = events.writeStream.foreachBatch(per_batch).option(
        "checkpointLocation", _checkpoint(spark, checkpoint, "volume"))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def drift_stream(spark: SparkSession, events: DataFrame, checks_path: str, checkpoint: str | None = None,
                 sample: int = 20, trigger: dict | None = None, table_path: str | None = None,
                 alert_table: str | None = None):
    """STR-5: schema snapshot per type, compared with the previous check.

    Each micro-batch is one check at its latest store time. The latest
    ``sample`` payloads per type are kept as state (``<checks>_latest``), to
    which a batch adds its rows, and the snapshots as a table merged by (type,
    hash) (``<checks>_snapshots``), whose last seen row per type is what a
    check compares with. ``table_path`` seeds the payloads once, where there is
    no state yet.
    """
    latest = LatestRows(spark, f"{checks_path.rstrip('/')}_latest", sample)
    image_path = f"{checks_path.rstrip('/')}_snapshots"

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        as_of = batch.agg(F.max("stored_at")).first()[0]
        if as_of is None:
            return
        run = _run(batch)
        rows = batch.select("id", "type", "payload", "stored_at")
        seen = latest.update(rows, run, batch_id, spark.read.parquet(table_path) if table_path else None)
        cur = D.current_schemas(seen.withColumn("check_at", F.lit(as_of)))
        folders = list(last_folders(spark, image_path, run, batch_id).values())
        image = spark.read.schema(SCHEMA_SNAPSHOTS).parquet(*folders) if folders else spark.createDataFrame([], SCHEMA_SNAPSHOTS)
        if len(folders) > 1:
            image = D.one_image(image)
        checks = D.outcomes(cur.join(D.latest_snapshots(image), "type", "left"))
        _write(checks, checks_path, run, batch_id)
        checks = spark.read.schema(checks.schema).parquet(f"{checks_path}/run={run}/batch={batch_id}")
        write_state(D.merge_snapshots(image, checks), image_path, run, batch_id)
        _alert(D.drift_alerts(checks), ["event_type", "check_at"], alert_table, run, batch_id)

    w = events.writeStream.foreachBatch(per_batch).option(
        "checkpointLocation", _checkpoint(spark, checkpoint, "drift"))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def content_stream(spark: SparkSession, vectors: DataFrame, alerts_path: str, checkpoint: str | None = None,
                   threshold: float = EMBED_THRESHOLD, sample: int = EMBED_BATCH, trigger: dict | None = None,
                   alert_table: str | None = None):
    """STR-7: the live content detector (EMB-1), one pass per micro-batch over the latest ``sample`` vectors per type,
    kept as state (``<alerts>_latest``). An event alerts once: ids of earlier alerts are left out."""
    latest = LatestRows(spark, f"{alerts_path.rstrip('/')}_latest", sample, order="seq")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        run = _run(batch)
        seen = latest.update(batch.select("id", "type", "seq", "vector"), run, batch_id)
        found = EMB.outliers(seen, threshold, sample=None)
        known = _others(_read_table(spark, alerts_path), run, batch_id)
        if known is not None:
            found = found.join(known.select("event_id"), "event_id", "left_anti").select(*found.columns)
        _write(found, alerts_path, run, batch_id)
        found = spark.read.schema(found.schema).parquet(f"{alerts_path}/run={run}/batch={batch_id}")
        _alert(found, ["event_type", "event_id"], alert_table, run, batch_id)

    w = vectors.writeStream.foreachBatch(per_batch).option(
        "checkpointLocation", _checkpoint(spark, checkpoint, "content"))
    return w.trigger(**(trigger or {"availableNow": True})).start()
